"""Tables that come from CSV members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import LATENCY, MARK_ABUSE, THREADSTAT_DESCRIPTION, THREADSTAT_EVENT, THREADSTAT_READ
from ..sources import csvfiles
from .quality import FILE, kept_rows
from .selection import not_sentinel, rename_prefix, without

# Columns that a load table doesn't keep.
ALWAYS_DROPPED = ("hostname", "interval")
DROPPED = {"cpu_all_cores_sadf": ("%idle",), "cpu_sadf": ("%idle",), "memory_sadf": ("%memused", "%commit")}
PER_CORE = "cpu_all_cores_sadf"

Made = tuple[DataFrame, DataFrame]
Stage = csvfiles.Stage


def _itself(df: DataFrame) -> DataFrame:
    return df


def _files(lines: DataFrame, files: DataFrame | None) -> DataFrame:
    return lines.select(*FILE).distinct() if files is None else files


def _declared(lines: DataFrame, schema: str, table: str, files: DataFrame | None, stage: Stage, once: bool = True, header: bool = True, keep: tuple[str, ...] = ()) -> Made:
    rows, bad = csvfiles.declared(lines, schema, header=header, keep=keep, stage=stage)
    return kept_rows(rows, bad, _files(lines, files), table, once)


def _tidy(rows: DataFrame) -> DataFrame:
    """Without a row's place but the id, which comes last; columns that made way for it get their names back."""
    rows = without(rows, "ord", "name", "line_no")
    rows = rows.select(*(F.col(f"`{c}`") for c in rows.columns if c != "id"), "id")
    return rows.withColumnsRenamed({f"{n}_": n for n in ("ord", "name", "line_no") if f"{n}_" in rows.columns})


def dacapo_latency(routed: DataFrame, files: DataFrame | None = None, stage: Stage = _itself) -> Made:
    """All latency files of all runs; ``latency_type`` names the table that a row belongs to."""
    rows, issues = _declared(routed, LATENCY, "dacapo_latency", files, stage, once=False, header=False, keep=("latency_type", "iteration"))
    return rows.select("start_ns", "owner", C.unsigned_diff(F.col("end_ns"), F.col("start_ns")).alias("duration_ns"), C.to_int(F.col("iteration")).alias("iteration"), F.replace("latency_type", F.lit("-"), F.lit("_")).alias("latency_type"), "id"), issues


def mark_abuse(routed: DataFrame, files: DataFrame | None = None, stage: Stage = _itself) -> Made:
    rows, issues = _declared(routed, MARK_ABUSE, "mark_abuse", files, stage, once=False, keep=("process",))
    return rows.select(C.from_epoch_ms(F.col("timestamp_ms")).alias("timestamp"), "gc_time_delta_ms", C.to_micros(F.col("time_s"), 1e6).alias("time_us"), C.to_int(F.col("process")).alias("process"), "id"), issues


def threadstat_event(lines: DataFrame, files: DataFrame | None = None, stage: Stage = _itself) -> Made:
    """Counts of -1 weren't measured and go; other negative counts become null."""
    rows, issues = _declared(lines, THREADSTAT_EVENT, "threadstat_event", files, stage)
    return not_sentinel(rows, "count").select("read_id", F.when(F.col("count") >= 0, F.col("count")).alias("count"), "event_id", "id"), issues


def threadstat_description(lines: DataFrame, files: DataFrame | None = None, stage: Stage = _itself) -> Made:
    rows, issues = _declared(lines, THREADSTAT_DESCRIPTION, "threadstat_counter_description", files, stage)
    return rows.select("event_id", F.col("name_").alias("name"), "pid", "id"), issues


def threadstat_read(lines: DataFrame, files: DataFrame | None = None, stage: Stage = _itself) -> Made:
    rows, issues = _declared(lines, THREADSTAT_READ, "threadstat_read", files, stage)
    return rows.select("read_id", C.from_epoch_ns(F.col("timestamp")).alias("timestamp"), F.col("timestamp").alias("timestamp_ns"), "time_running", "time_enabled", "id"), issues


# Fixed value: what stands before the header of a load export.
LOAD_COMMENT = "# "


def load_table(lines: DataFrame, table: str, sep: str = ";", files: DataFrame | None = None, stage: Stage | None = None) -> Made:
    """A load export as a table, from its lines; see ``load_of``."""
    split = (stage or csvfiles.spooled)(csvfiles.split_records(lines, sep, LOAD_COMMENT))
    return load_of(split, table, files)


def load_of(split: DataFrame, table: str, files: DataFrame | None = None) -> Made:
    """A load export as a table: its time read, the host's columns dropped, the whole-machine row of the per-core table left out.

    A file with a time that isn't one is bad.
    """
    rows, bad, own = csvfiles.typed(split, {"timestamp": lambda c: C.parse_sadf(c).isNotNull()})
    rows = rename_prefix(rows, "%idle[", "%idle")
    if "timestamp" in rows.columns:
        rows = rows.withColumn("timestamp", C.parse_sadf(F.col("timestamp").cast("string")))
    rows, issues = kept_rows(rows, bad, own if files is None else files, table)
    rows = without(_tidy(rows), *ALWAYS_DROPPED, *DROPPED.get(table, ()))
    return (not_sentinel(rows, "CPU") if table == PER_CORE and "CPU" in rows.columns else rows), issues


def time_table(lines: DataFrame, files: DataFrame | None = None, stage: Stage | None = None) -> Made:
    """Process times; the per cent sign goes from cpu_percent, which becomes a whole number or null."""
    rows, bad = csvfiles.inferred(lines, stage=stage)
    rows, issues = kept_rows(rows, bad, _files(lines, files), "time")
    rows = _tidy(rows)
    return (rows.withColumn("cpu_percent", C.to_int(C.strip_suffix(F.col("cpu_percent").cast("string"), "%"), C.U32)) if "cpu_percent" in rows.columns else rows), issues


def git_info(lines: DataFrame, files: DataFrame | None = None, stage: Stage | None = None) -> Made:
    rows, bad = csvfiles.inferred(lines, stage=stage)
    rows, issues = kept_rows(rows, bad, _files(lines, files), "git_info")
    return _tidy(rows), issues
