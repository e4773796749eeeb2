"""Which runs to collect, with which collectors, and what to keep of a table's columns."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COLLECTORS, KINDS, RUN
from ..sources.manifest import Task
from .quality import issue


def membership(wanted: dict[str, list], strict: bool = True) -> Column:
    """Whether a run has, for every key, one of the listed values; an attribute that is absent isn't listed.

    No keys match every run; an empty list matches none. Unknown keys are an error unless ``strict`` is off,
    when they are passed over.
    """
    unknown = sorted(set(wanted) - set(KINDS))
    if unknown and strict:
        raise ValueError(f"unknown attributes in a filter: {', '.join(unknown)}")
    tests = [F.coalesce(F.col(key).isin(values), F.lit(False)) if values else F.lit(False) for key, values in wanted.items() if key in KINDS]
    return functools.reduce(operator.and_, tests, F.lit(True))


def select_runs(runs: DataFrame, task: Task, strict: bool = True) -> DataFrame:
    """Runs that belong to a collection at least, with the names of theirs in the array ``collections``."""
    labels = F.array(*(F.when(membership(wanted, strict), F.lit(name)) for name, wanted in sorted(task.collect.items())))
    named = runs.withColumn("collections", F.array_distinct(F.filter(labels, lambda x: x.isNotNull())))
    return named.filter(F.size("collections") > 0)


def route_collectors(runs: DataFrame, table: dict[str, tuple[str, ...]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, collector) for each run of a known benchmark, and an issue for each other run."""
    table = COLLECTORS if table is None else table
    known = F.create_map(*(x for name, own in table.items() for x in (F.lit(name), F.array(*map(F.lit, own)))))
    own = runs.select("id", "benchmark", F.try_element_at(known, F.col("benchmark")).alias("own"))
    issues = issue(own.filter("own is null"), "run", None, F.concat(F.lit("no collectors for benchmark "), F.coalesce("benchmark", F.lit(""))))
    return own.filter("own is not null").select("id", F.explode("own").alias("collector")), issues


def gc_gate(lines: DataFrame, runs: DataFrame, word: str) -> DataFrame:
    """Lines of the runs whose collector's name holds ``word`` in either case; runs that name none are left out."""
    return lines.join(runs.filter(F.lower("gc").contains(word)).select("id"), "id", "left_semi")


def without(df: DataFrame, *names: str) -> DataFrame:
    """All columns but these; names that aren't there don't matter."""
    return df.drop(*names)


def rename_prefix(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """The first column that starts with ``prefix`` gets ``name``; where there is none, nothing changes."""
    found = next((c for c in df.columns if c.startswith(prefix)), None)
    return df if found is None else df.withColumnRenamed(found, name)


def not_sentinel(df: DataFrame, column: str, sentinel: int = -1) -> DataFrame:
    """Rows whose value is there and isn't the sentinel."""
    return df.filter(F.col(f"`{column}`") != sentinel)


def config_table(runs: DataFrame) -> DataFrame:
    """The run attributes in declaration order, absent ones as typed nulls, then the id."""
    have = set(runs.columns)
    return runs.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN), "id")


def fan_out(df: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of each collection that the row's run belongs to: extraction runs once, rows are repeated after it."""
    named = df.join(selected.select("id", F.explode("collections").alias("collection")), "id")
    return named.select(*(F.col(f"`{c}`") for c in df.columns), "collection")
