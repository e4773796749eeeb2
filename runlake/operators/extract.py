"""Log text to typed tables: one plan for all runs, from a pattern and the meaning of its groups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.csvfiles import spooled
from .quality import FILE, file_verdicts, rows_of
from .reduce import first_wins, last_wins, lookup_with_default, only_in, ordinal, suffix_sum

Made = tuple[DataFrame, DataFrame]
Stage = Callable[[DataFrame], DataFrame]

text: Callable[[Column], Column] = lambda c: c
trimmed: Callable[[Column], Column] = C.trim_ws
u32: Callable[[Column], Column] = lambda c: C.to_int(c, C.U32)
u8: Callable[[Column], Column] = lambda c: C.to_int(c, 255)


@dataclass(frozen=True)
class Grammar:
    """Lines with ``marker`` are searched for ``pattern``; ``fields`` names its groups in order, with their readers.

    A field whose reader gives null fails its whole file, unless it is named in ``lenient``.
    """

    marker: str
    pattern: str
    fields: dict[str, Callable[[Column], Column]]
    lenient: tuple[str, ...] = field(default=())


# The shapes of log lines. Letters, digits and spaces are of any script, as the writers' tools have it.
_CLOCK, _INFO = r"\[([^\]]*)\]", r"\[info\s*\]"
_PAIR = r"(\d+(?:\.\d+)?) / (\d+(?:\.\d+)?)"
ZGC_PHASE = Grammar("[gc,phases", rf"(?Ud){_CLOCK}{_INFO}\[gc,phases\s*\] GC\((\d+)\) ([YOyo]): ([A-Za-z \-]+) ([0-9.]+)ms", {"clock_text": text, "gc_number": u32, "letter": text, "name": trimmed, "time_ms": C.to_float})
ZGC_SUMMARY = Grammar("Collection (", rf"(?Ud){_CLOCK}{_INFO}\[gc\s*\] GC\((\d+)\) (Major|Minor) Collection \(([^)]+)\) (\d+)M\((\d+)%\)->(\d+)M\((\d+)%\) ([0-9.]+)s", {"clock_text": text, "gc_number": u32, "kind": text, "cause": text, "start_memory_mb": C.to_int, "start_percent": u8, "end_memory_mb": C.to_int, "end_percent": u8, "time_s": C.to_float})
ZGC_STATS = Grammar("[gc,stats", rf"(?Ud){_CLOCK}{_INFO}\[gc,stats\s*\]\s+([\w ]+): (.+?)\s{{2,}}{_PAIR}\s+{_PAIR}\s+{_PAIR}\s+{_PAIR}\s+(\S+)", {"clock_text": text, "stat_type": trimmed, "name": trimmed} | {f"{span}_{what}": C.to_float for span in ("last_10s", "last_10m", "last_10h", "total") for what in ("avg", "max")} | {"unit": text})
ZGC_WORKERS = Grammar("[gc,task", r"(?Ud)\[gc,task\s*\] GC\((\d+)\) Using (\d+) Workers for (\w+) Generation", {"gc_number": u32, "num_workers": u32, "generation": text})
G1_PHASE = Grammar("[gc,phases", rf"(?Ud){_CLOCK}{_INFO}\[gc,phases\s*\] GC\((\d+)\)\s+([A-Za-z ]+):\s+([0-9.]+)ms", {"clock_text": text, "gc_number": u32, "name": trimmed, "time_ms": C.to_float})
G1_TYPE = Grammar("[gc", rf"(?Ud){_INFO}\[gc\s*\] GC\((\d+)\) (Pause Young \([^)]+\)|Pause \w+|Concurrent [A-Za-z ]+?)(?:\s+\(G1|\s+\d|\s*$)", {"gc_number": u32, "gc_type": trimmed})
CREATED = Grammar("Thread created", r'(?Ud)\[[^\]]*\]\[[^\]]*\]\[[^\]]*\] Thread created tid: ([0-9]*), name:"([^"]*)", thread_type:"([^"]*)"', {"pid": C.to_int, "thread_name": text, "thread_type": text})
ATTACHED = Grammar("Thread attached", r"(?Ud)\[[^\]]*\]\[[^\]]*\]\[[^\]]*\] Thread attached \(tid: ([0-9]+)\s*,", {"pid": C.to_int})
ITERATION = Grammar("DaCapo", r"(?Ud)DaCapo.*in (\d+) msec", {"dacapo_iteration_time_ms": C.to_int}, ("dacapo_iteration_time_ms",))
SCORE = Grammar("jbb2015.result.", r"(?Ud)jbb2015\.result\.(metric\.max-jOPS|metric\.critical-jOPS|SLA-\d+-jOPS)\s*=\s*(\d+)", {"metric": text, "value": C.to_int})
PROFILE = Grammar("org.spec.jbb.controller", r"(?Ud)<([A-Za-z]{3}) ([A-Za-z]{3})\s+(\d{1,2}) (\d{2}:\d{2}:\d{2}) ([A-Za-z]+) (\d{4})> org\.spec\.jbb\.controller: (PROFILE|RT_CURVE|VALIDATION|TRANSITION|WARMUP): .*?\(rIR:aIR:PR = (\d+):(\d+):(\d+)\) \(tPR = (\d+)\)", {"weekday": text, "month": text, "day": C.to_int, "time": text, "offset": C.zone_offset, "year": text, "phase": text, "requested_ir": C.to_int, "achieved_ir": C.to_int, "passed_requests": C.to_int, "total_passed_requests": C.to_int})


#: What parts the groups of a match while they are read at once.
_MARK = "\x01"


def captures(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """A row for each match in each line: the line's place, ``pos`` in the line, raw groups as ``raw_<field>``.

    All groups of a match are read at once, with a mark round each; where the match holds the mark itself, or isn't matched whole, one by one.
    """
    hit, n = F.posexplode(F.regexp_extract_all("line", F.lit(grammar.pattern), F.lit(0))).alias("pos", "hit"), len(grammar.fields)
    marked = F.regexp_replace("hit", grammar.pattern, _MARK + "".join(f"${i}{_MARK}" for i in range(1, n + 1)))
    found = lines.filter(F.col("line").contains(grammar.marker)).select(*lines.columns, hit).withColumn("__parts", F.split(marked, _MARK))
    whole = (F.size("__parts") == n + 2) & (F.get("__parts", F.lit(0)) == "") & (F.get("__parts", F.lit(n + 1)) == "")
    raw = lambda i: F.when(whole, F.get("__parts", F.lit(i))).otherwise(F.regexp_extract("hit", grammar.pattern, i))
    return found.select(*lines.columns, "pos", *(raw(i).alias(f"raw_{name}") for i, name in enumerate(grammar.fields, 1)))


def read_fields(found: DataFrame, grammar: Grammar) -> DataFrame:
    """The groups read; ``bad`` where a field that must be read can't be, with the first such one in ``why``."""
    read = {n: f(F.col(f"raw_{n}")) for n, f in grammar.fields.items()}
    bad, why = F.lit(False), F.lit(None).cast("struct<field:string,value:string>")
    for n, c in reversed(read.items()):
        if n not in grammar.lenient:
            bad = bad | c.isNull()
            why = F.when(c.isNull(), F.struct(F.lit(n).alias("field"), F.col(f"raw_{n}").alias("value"))).otherwise(why)
    keep = [c for c in found.columns if not c.startswith("raw_") and c not in grammar.fields]
    # the name of the file makes way for a field of that name
    keep = [F.col(c) for c in keep] + ([F.col("name").alias("file_name")] if "name" in grammar.fields else [])
    return found.select(*keep, *(c.alias(n) for n, c in read.items()), bad.alias("bad"), why.alias("why"))


def extract(lines: DataFrame, grammar: Grammar, table: str, once: bool = True, files: DataFrame | None = None, stage: Stage = spooled) -> Made:
    """The table's rows (with id, ord, line_no, pos) and issues, for text lines of the files that feed it.

    A file with a field that can't be read gives no rows; its issue tells the first one. With ``once`` only each run's first good file
    counts; otherwise all good files do. ``files`` are the files that feed the table (id, ord, name, perhaps fault), or
    else found from the lines. ``stage`` writes what is captured and reads it back, so that lines are read once.
    """
    rows = read_fields(captures(lines, grammar), grammar)
    file_name = "file_name" if "name" in grammar.fields else "name"
    rows = stage(rows.drop(file_name, "line", "is_last", "error", "fault", "last_text", "file_kind"))
    first = rows.filter("bad").groupBy("id", "ord").agg(F.min_by(F.struct("line_no", "why"), F.struct("line_no", "pos")).alias("at"))
    failed = first.select("id", "ord", F.lit(True).alias("__bad"), "at.line_no", "at.why.field", "at.why.value")
    files = lines.select(*FILE).distinct() if files is None else files
    kept, issues = file_verdicts(files.join(failed, ["id", "ord"], "left"), F.coalesce("__bad", F.lit(False)), table, once)
    return rows_of(rows.filter("not bad").drop("bad", "why"), files, kept, ["id", "ord"]), issues


def zgc_phases(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, ZGC_PHASE, "zgc_phases", **how)
    clock = C.parse_iso(F.col("clock_text"))
    letter = F.col("letter")
    return rows.select(
        clock.alias("clock_time"), "gc_number", F.lower(letter).alias("age"), F.when(letter == F.lower(letter), "minor").otherwise("major").alias("type"),
        "name", C.to_micros(F.col("time_ms"), 1e3).alias("time_us"), C.minus_ms(clock, F.col("time_ms")).alias("start_time"), "id",
    ), issues


def zgc_gc_summary(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, ZGC_SUMMARY, "zgc_gc_summary", **how)
    return rows.select(
        C.parse_iso(F.col("clock_text")).alias("end_time"), "gc_number", F.lower("kind").alias("type"), "cause", "start_memory_mb",
        F.col("start_percent").cast("smallint").alias("start_percent"), "end_memory_mb", F.col("end_percent").cast("smallint").alias("end_percent"),
        C.to_micros(F.col("time_s"), 1e6).alias("time_us"), "id",
    ), issues


def zgc_stats(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, ZGC_STATS, "zgc_stats", **how)
    numbers = [n for n in ZGC_STATS.fields if n.endswith(("_avg", "_max"))]
    return rows.select(C.parse_iso(F.col("clock_text")).alias("clock_time"), "stat_type", "name", "unit", *numbers, "id"), issues


def zgc_task_workers(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, ZGC_WORKERS, "zgc_task_workers", **how)
    return rows.select("gc_number", F.when(F.lower("generation") == "young", "y").otherwise("o").alias("age"), "num_workers", "id"), issues


def g1_types(lines: DataFrame, files: DataFrame | None = None, stage: Stage = lambda df: df) -> DataFrame:
    """(id, ord, gc_number, gc_type): the first type that a log gives each collection.

    A line that ends with its type counts only if nothing but blank space follows in the file, or the next text
    starts with a digit: the pattern's end is the end of the text, and its gap may span lines. Only lines of types,
    blank ones and those that start with a digit are looked at, which are few in a log; where a file's text ends
    comes from ``files``, or else from the lines.
    """
    line, place = F.col("line"), ["id", "ord", "line_no"]
    blank, digit = F.trim(line) == "", line.rlike(r"(?Ud)^\s*\d")
    bare = line.rlike(r"(?Ud)\[gc\s*\] GC\(\d+\) (Pause Young \([^)]+\)|Pause \w+|Concurrent [A-Za-z ]+?)\s*$")
    typed = line.rlike(G1_TYPE.pattern)
    few = stage(lines.filter(blank | digit | bare | typed).select("id", "ord", "name", "line_no", "line", blank.alias("blank"), digit.alias("digit"), bare.alias("bare")))
    if files is not None and "last_text" in files.columns:
        ends = files.select("id", "ord", F.col("last_text").alias("line_no"))
    else:
        ends = lines.filter(~blank).groupBy("id", "ord").agg(F.max("line_no").alias("line_no"))
    run = F.col("line_no") - F.row_number().over(Window.partitionBy("id", "ord").orderBy("line_no"))
    after = F.lead("digit").over(Window.partitionBy("id", "ord", "run").orderBy("line_no"))
    followed = few.withColumn("run", run).filter("not blank").withColumn("after", after).filter("after").select(*place)
    counted = ends.select(*place).unionByName(followed).distinct()
    found = captures(few.select("id", "ord", "name", "line_no", "line", "bare"), G1_TYPE)
    found = found.filter("not bare").unionByName(found.filter("bare").join(counted, place, "left_semi").select(found.columns))
    return first_wins(read_fields(found, G1_TYPE), ["id", "ord", "gc_number"], ["line_no", "pos"], "gc_type")


def g1_phases(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, G1_PHASE, "g1_phases", **how)
    rows = lookup_with_default(rows, g1_types(lines, **how), ["id", "ord", "gc_number"], "gc_type")
    rows = suffix_sum(rows, "time_ms", ["id", "ord", "gc_number"], ["line_no", "pos"], "rest_ms")
    clock = C.parse_iso(F.col("clock_text"))
    return rows.select(clock.alias("clock_time"), "gc_number", "gc_type", "name", C.to_micros(F.col("time_ms"), 1e3).alias("time_us"), C.minus_ms(clock, F.col("rest_ms")).alias("start_time"), "id"), issues


def java_threads(lines: DataFrame, **how) -> Made:
    made, issues = extract(lines, CREATED, "java_threads", **how)
    made = last_wins(made, ["id", "pid"], ["ord", "line_no", "pos"], ["thread_name", "thread_type"])
    attached, _ = extract(lines, ATTACHED, "java_threads", **how)
    others = only_in(attached, made, ["id", "pid"]).withColumns({"thread_name": F.lit("unknown"), "thread_type": F.lit("unknown")})
    return made.unionByName(others).select("pid", "thread_name", "thread_type", "id"), issues


def dacapo_iteration(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, ITERATION, "dacapo_iteration", **how)
    rows = ordinal(rows.filter("dacapo_iteration_time_ms is not null"), ["id"], ["line_no", "pos"], "dacapo_iteration")
    return rows.select("dacapo_iteration", "dacapo_iteration_time_ms", "id"), issues


def specjbb_summary(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, SCORE, "specjbb_summary", **how)
    return rows.select("metric", "value", "id"), issues


def specjbb_profile(lines: DataFrame, **how) -> Made:
    rows, issues = extract(lines, PROFILE, "specjbb_profile", **how)
    clock = C.parse_offset(F.col("month"), F.col("day").cast("string"), F.col("time"), F.col("offset"), F.col("year"), F.col("weekday"))
    return rows.select(clock.alias("clock_time"), "phase", "requested_ir", "achieved_ir", "passed_requests", "total_passed_requests", "id"), issues
