"""Which file feeds which table: a rule for each name, prefix, suffix or pattern."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Files whose whole name matches ``pattern`` feed ``table``; captures become columns of these names."""

    table: str
    pattern: str
    captures: tuple[str, ...] = ()


def exact(table: str, *names: str) -> list[Rule]:
    return [Rule(table, "^" + name.replace(".", r"\.") + "$") for name in names]


# The names of files in an archive. jvm0.txt stands in for three files of newer runs.
GC_LOG, OS_LOG, OUTPUT = ("gc.javalog", "jvm0.txt"), ("os.javalog", "jvm0.txt"), ("jvm0.stdout", "jvm0.txt")
RULES: list[Rule] = [
    *exact("zgc_phases", *GC_LOG),
    *exact("zgc_gc_summary", *GC_LOG),
    *exact("zgc_stats", *GC_LOG),
    *exact("zgc_task_workers", *GC_LOG),
    *exact("g1_phases", *GC_LOG),
    *exact("java_threads", *OS_LOG),
    *exact("os_log", *OS_LOG),
    *exact("dacapo_iteration", *OUTPUT),
    *exact("status", "status.txt"),
    *exact("time", "jvm0.time"),
    *exact("git_info", "git_info.csv"),
    *exact("threadstat_event", "threadstat-event.csv"),
    *exact("threadstat_counter_description", "threadstat-event-description.csv"),
    *exact("threadstat_read", "threadstat-read.csv"),
    Rule("runner_exit", r"^runner\+?([0-9]+)\.exit$", ("runner",)),
    Rule("dacapo_latency", r"^dacapo-latency-usec-([a-zA-Z0-9-]+)-([0-9]+)\.csv$", ("latency_type", "iteration")),
    Rule("mark_abuse", r"^mark_abuse([0-9]+)\.csv$", ("process",)),
    *exact("cpu_sadf", "cpu_data.csv"),
    Rule("sadf", r"^(.*)\.sadf$", ("stem",)),
    Rule("specjbb_summary", r"^.*\.raw$"),
    Rule("specjbb_profile", r"^.*-Controller\.log$"),
]
CAPTURES = ("runner", "latency_type", "iteration", "process", "stem")


def tables_of(name: Column, rules: list[Rule] | None = None) -> Column:
    """The tables that a file feeds, with the rule's captures; an array, for one file may feed several."""
    rules = RULES if rules is None else rules

    def made(rule: Rule) -> Column:
        captured = [F.regexp_extract(name, rule.pattern, rule.captures.index(c) + 1) if c in rule.captures else F.lit(None).cast("string") for c in CAPTURES]
        return F.when(name.rlike(rule.pattern), F.struct(F.lit(rule.table).alias("table"), *(c.alias(n) for c, n in zip(captured, CAPTURES, strict=True))))

    return F.filter(F.array(*(made(r) for r in rules)), lambda x: x.isNotNull())


def route_files(lines: DataFrame, tables: tuple[str, ...] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Lines of the files that feed a table, once for each: adds ``table`` and the captures as columns."""
    rules = [r for r in (RULES if rules is None else rules) if tables is None or r.table in tables]
    return lines.withColumn("__to", F.explode(tables_of(F.col("name"), rules))).select(*lines.columns, "__to.*")


def kind_of(name: Column, rules: list[Rule]) -> Column:
    """Which patterns a file's name matches, by their place among all: '' for none. Few names match more than one."""
    patterns = patterns_of(rules)
    return F.concat_ws("+", *(F.when(name.rlike(p), F.lit(str(i))) for i, p in enumerate(patterns)))


def patterns_of(rules: list[Rule]) -> list[str]:
    return list(dict.fromkeys(r.pattern for r in rules))


def feeds(kind: Column, wanted: list[Rule], rules: list[Rule]) -> Column:
    """Whether files of a kind match one of the wanted rules: a condition on the kind alone, so that it prunes partitions."""
    places = [str(i) for i, p in enumerate(patterns_of(rules)) if any(r.pattern == p for r in wanted)]
    return F.arrays_overlap(F.split(kind, r"\+"), F.array(*map(F.lit, places)))
