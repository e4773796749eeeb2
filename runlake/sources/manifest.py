"""The task file, the run manifest, and where each run's archive lies."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import TextIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import zero_hex
from ..schema import KINDS, REQUIRED_KINDS, RUN


@dataclass(frozen=True)
class Task:
    """What to collect: the location, a filter for each collection, and tables not to write."""

    location: str
    collect: dict[str, dict[str, list]]
    drop_tables: tuple[str, ...] = field(default=())


def parse_task(text: str) -> Task:
    raw = json.loads(text)
    return Task(raw["location"], raw["collect"], tuple(raw.get("drop_tables", ())))


def load_task(spark: SparkSession, path: str) -> Task:
    """Read a task file, a small configuration, from any file system that Spark knows."""
    return parse_task(spark.read.text(path, wholetext=True).first()[0])


def parse_runs(manifests: DataFrame, column: str = "value") -> DataFrame:
    """One row for each run of each manifest text: id and the run attributes.

    A run with an unknown attribute, without a required one, or with an id that isn't a whole number
    fails the load.
    """
    runs = F.expr(f"from_json(get_json_object({column}, '$.benchmark_runs'), 'map<string,string>')")
    return checked_runs(manifests.select(F.explode(runs).alias("key", "run")))


def checked_runs(each: DataFrame) -> DataFrame:
    """Runs from rows of (key, run), a run being its JSON text; what breaks a rule ends the load."""
    unknown = F.array_except(F.json_object_keys("run"), F.array(*(F.lit(n) for n in KINDS)))
    lacking = F.array_except(F.array(*(F.lit(n) for n in REQUIRED_KINDS)), F.json_object_keys("run"))
    number = F.when(F.col("key").rlike("^[0-9]+$"), F.col("key")).try_cast("bigint")
    wrong = (
        F.when(number.isNull(), F.concat(F.lit("invalid run id "), F.col("key")))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown attribute "), unknown[0]))
        .when(F.size(lacking) > 0, F.concat(F.lit("missing attribute "), lacking[0]))
    )
    checked = each.withColumn("id", F.when(wrong.isNotNull(), F.raise_error(wrong).cast("bigint")).otherwise(number))
    parsed = checked.select("id", F.from_json("run", RUN, {"mode": "FAILFAST"}).alias("run"))
    return parsed.select("id", "run.*")


#: Characters of a manifest that are read at a time, and runs of a batch.
PIECE, BATCH_RUNS = 1 << 20, 2000
_GAP = re.compile(r"[\s,:]*")


def runs_in(text: TextIO, piece: int = PIECE) -> Iterator[tuple[str, str]]:
    """(key, JSON text) of each run of a manifest, which is read piece by piece; no more than a run and a piece is held.

    A manifest that isn't one JSON object, or ends before its end, is an error.
    """
    decode = json.JSONDecoder().raw_decode
    held, at, ended = "", 0, False

    def more() -> bool:
        nonlocal held, at, ended
        got = text.read(piece)
        held, at, ended = held[at:] + got, 0, not got
        return bool(got)

    def letter() -> str:
        """The next letter that isn't between values."""
        nonlocal at
        while True:
            at = _GAP.match(held, at).end()
            if at < len(held) or not more():
                return held[at : at + 1]

    def value() -> tuple[object, str]:
        """The next value and its text; as long as nothing that parts values follows it, it may go on, so more is read first."""
        nonlocal at
        letter()
        while True:
            try:
                found, end = decode(held, at)
                if held[end : end + 1].isspace() or held[end : end + 1] in (",", ":", "]", "}"):
                    break
                if ended:
                    raise ValueError("a manifest ends before its end")
            except json.JSONDecodeError:
                if ended:
                    raise
            more()
        start, at = at, end
        return found, held[start:end]

    def entered(what: str) -> None:
        nonlocal at
        if letter() != "{":
            raise ValueError(f"{what} is no JSON object")
        at += 1

    entered("a manifest")
    while (sign := letter()) != "}":
        if not sign:
            raise ValueError("a manifest ends before its end")
        if value()[0] != "benchmark_runs":
            value()
            continue
        entered("benchmark_runs")
        while (sign := letter()) != "}":
            if not sign:
                raise ValueError("a manifest ends before its end")
            key = value()[0]
            yield str(key), value()[1]
        at += 1


def stream_runs(spark: SparkSession, *paths: str) -> DataFrame:
    """Runs of manifests at paths that executors can open, a task for each; they may have any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with open(path.removeprefix("file:"), encoding="utf-8") as text:
                    rows = []
                    for row in runs_in(text):
                        rows.append(row)
                        if len(rows) == BATCH_RUNS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["key", "run"])
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["key", "run"])

    cores = spark.sparkContext.defaultParallelism
    each = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths), "path").mapInArrow(run, "key string, run string")
    return checked_runs(each.repartition(cores, "key"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of the manifest at ``path``: streamed where executors can open it, else through Spark's reader as one text."""
    if path.startswith("file:") or "://" not in path:
        return stream_runs(spark, path)
    return parse_runs(spark.read.text(path, wholetext=True))


def archive_path(id_: Column, location: str) -> Column:
    return F.concat(F.lit(f"{location.rstrip('/')}/runs/"), zero_hex(id_), F.lit(".tar.xz"))


def archive_id(path: Column) -> Column:
    return F.conv(F.regexp_extract(path, r"([0-9A-F]{16})\.tar\.xz$", 1), 16, 10).try_cast("bigint")
