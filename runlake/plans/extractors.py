"""Extractors: what turns the files that a rule names into tables, built in or one's own.

Most formats need a grammar or plain DataFrame code over all runs (``Extractor``). One that must see a run's files in order and
keep something between them is a ``StatefulExtractor``: Spark sorts the lines of each run into one stream, of which Python holds a
batch at a time and whatever the extractor keeps.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.extract import Grammar, extract
from ..operators.quality import issue
from ..sources.routing import Rule, route_files

Made = tuple[DataFrame, DataFrame]
Rows = Iterable[tuple[str, dict[str, Any]]]


@dataclass(frozen=True)
class Extractor:
    """A table, the rules of its files, and how lines become rows: a grammar, or a function of lines.

    The function takes the routed text lines of all runs, without files that aren't UTF-8, and returns (rows,
    issues); it is plain DataFrame code. ``gate`` is a word that the run's collector must hold for its files to be read,
    ``benchmarks`` are those whose runs are read, all if there are none, and ``endings`` are those of its files' names; without
    any, every member of an archive is read.
    """

    table: str
    rules: tuple[Rule, ...]
    how: Grammar | Callable[[DataFrame], Made]
    gate: str | None = None
    endings: tuple[str, ...] = ()
    benchmarks: tuple[str, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.table,)


class FileProblem(Exception):
    """Raised by a stateful extractor for a file that it can't read: an issue, not the job's end. The file's further lines are passed over."""


class RunState(Protocol):
    """What a stateful extractor keeps of one run. Both methods give rows as (table, values by column name)."""

    def read(self, name: str, lines: list[str], first: int) -> Rows:
        """Takes the next lines of a file, which ``first`` numbers; a file may come in several calls, one file after another."""

    def finish(self) -> Rows:
        """The rest, after the run's last file; also called for a run without any file."""


@dataclass(frozen=True)
class StatefulExtractor:
    """Several tables from all files of a run that the rules name, in the archive's order.

    ``schemas`` gives each table its columns, ``make`` is called once for each run with its attributes by name, and gives
    a ``RunState``. ``gate``, ``benchmarks`` and ``endings`` are as in ``Extractor``.
    """

    name: str
    rules: tuple[Rule, ...]
    schemas: dict[str, str]
    make: Callable[[dict[str, Any]], RunState]
    gate: str | None = None
    endings: tuple[str, ...] = ()
    benchmarks: tuple[str, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        return tuple(self.schemas)


_OWN: dict[str, Extractor | StatefulExtractor] = {}


def register_extractor(extractor: Extractor | StatefulExtractor) -> Extractor | StatefulExtractor:
    """Make an extractor part of every collection from now on."""
    taken = {t for e in _OWN.values() for t in e.tables}
    for table in extractor.tables:
        if table in taken:
            raise ValueError(f"there is an extractor for {table} already")
    _OWN["+".join(extractor.tables)] = extractor
    return extractor


def registered() -> list[Extractor | StatefulExtractor]:
    return list(_OWN.values())


def runs_of(extractor: Extractor | StatefulExtractor, runs: DataFrame) -> DataFrame:
    """The runs that an extractor reads: those of its benchmarks whose collector's name holds its word."""
    runs = runs.filter(F.col("benchmark").isin(*extractor.benchmarks)) if extractor.benchmarks else runs
    return runs.filter(F.lower("gc").contains(extractor.gate)) if extractor.gate else runs


def run_extractor(extractor: Extractor, lines: DataFrame, **how) -> Made:
    """The table's rows and issues from the text lines of all runs; ``how`` is for ``extract``."""
    routed = route_files(lines, rules=list(extractor.rules))
    return extract(routed, extractor.how, extractor.table, **how) if isinstance(extractor.how, Grammar) else extractor.how(routed)


#: Rows of a batch that leave a stateful extractor.
BATCH_ROWS = 5000
_PROBLEM = T.StructType([T.StructField("name", T.StringType()), T.StructField("message", T.StringType())])


class _Run:
    """One run's state; gives rows as (id, table, values), and problems under no table."""

    def __init__(self, extractor: StatefulExtractor, id_: int, attributes: dict[str, Any]):
        self.id, self.state, self.bad = id_, extractor.make(attributes), None

    def read(self, ord_: int, name: str, lines: list[str], first: int) -> Iterator[tuple]:
        if ord_ == self.bad:
            return
        try:
            for table, values in self.state.read(name, lines, first):
                yield self.id, table, values
        except FileProblem as problem:
            self.bad = ord_
            yield self.id, None, {"name": name, "message": f"failed to read: {problem}"}

    def finish(self) -> Iterator[tuple]:
        try:
            for table, values in self.state.finish():
                yield self.id, table, values
        except FileProblem as problem:
            yield self.id, None, {"name": None, "message": f"failed to finish: {problem}"}


def run_stateful(extractor: StatefulExtractor, lines: DataFrame, runs: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df, parts: int | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each table's rows, with the run's id last, and the issues.

    ``lines`` are text lines of the extractor's files, ``runs`` those that it reads, with their attributes. ``stage`` may write what is made
    and read it back, so that the extractor runs once for all of its tables. A run's lines are one stream of one task;
    runs are spread over tasks.
    """
    schemas = {t: T._parse_datatype_string(ddl) for t, ddl in extractor.schemas.items()}
    out = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(t, s) for t, s in schemas.items()), T.StructField("__problem", _PROBLEM)])
    kinds = {f.name: f.type for f in to_arrow_schema(out) if f.name != "id"}

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in rows], pa.int64())]
        columns += [pa.array([r[2] if (r[1] or "__problem") == n else None for r in rows], k) for n, k in kinds.items()]
        return pa.RecordBatch.from_arrays(columns, names=["id", *kinds])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        run: _Run | None = None
        for whole in batches:
            ids, ords, names, numbers, texts = (whole[c].to_pylist() for c in ("id", "ord", "name", "line_no", "line"))
            at = 0
            while at < len(ids):
                until = at + 1
                while until < len(ids) and ids[until] == ids[at] and ords[until] == ords[at] and ords[at] >= 0:
                    until += 1
                if ords[at] < 0:  # a run begins with its attributes
                    if run:
                        yield from run.finish()
                    run = _Run(extractor, ids[at], json.loads(texts[at]))
                elif run and run.id == ids[at]:
                    yield from run.read(ords[at], names[at], texts[at:until], numbers[at])
                at = until
        if run:
            yield from run.finish()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in made(batches):
            rows.append(row)
            if len(rows) >= BATCH_ROWS:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    attributes = F.to_json(F.struct(*(F.col(c) for c in runs.columns if c != "collections")), {"ignoreNullFields": "false"})
    heads = runs.select("id", F.lit(-1).alias("ord"), F.lit("").alias("name"), F.lit(0).cast("bigint").alias("line_no"), attributes.alias("line"))
    named = functools.reduce(operator.or_, (F.col("name").rlike(r.pattern) for r in extractor.rules))
    stream = heads.unionByName(lines.filter(named).select("id", "ord", "name", "line_no", "line"))
    parts = parts or max(runs.sparkSession.sparkContext.defaultParallelism, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = stage(stream.repartition(parts, "id").sortWithinPartitions("id", "ord", "line_no").mapInArrow(work, out))
    tables = {t: rows.filter(F.col(f"`{t}`").isNotNull()).select(*(F.col(f"`{t}`.`{f.name}`").alias(f.name) for f in s), "id") for t, s in schemas.items()}
    wrong = rows.filter("__problem is not null").select("id", "__problem.*")
    return tables, issue(wrong, "collector", extractor.name, F.col("message"))
