"""Reductions, lookups and windows over the tables of all runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.columns import U32, to_int, trim_ws
from .quality import file_verdicts, issue


def first_wins(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """For each key the value that comes first."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(value))


def last_wins(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """For each key the values that come last."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__last"))
    return last.select(*keys, *(F.col(f"__last.{v}").alias(v) for v in values))


def lookup_with_default(left: DataFrame, right: DataFrame, keys: list[str], column: str, default: str = "") -> DataFrame:
    """``column`` of the one matching row of ``right``, or the default."""
    return left.join(right.select(*keys, column), keys, "left").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` doesn't have, each once."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def suffix_sum(df: DataFrame, value: str, partition: list[str], order: list[str], name: str) -> DataFrame:
    """The sum of ``value`` from each row to the last of its partition, added from the last row backwards.

    The direction matters: sums of doubles depend on the order of adding, and whole parts are taken of them.
    """
    window = Window.partitionBy(*partition).orderBy(*(F.col(o).desc() for o in order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(window))


def ordinal(df: DataFrame, partition: list[str], order: list[str], name: str) -> DataFrame:
    """The number of each row in its partition, from 0."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1).cast("bigint"))


def union_tables(dfs: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def run_status(runs: DataFrame, status: DataFrame, exits: DataFrame, os_lines: DataFrame) -> DataFrame:
    """(id, status) for every run: its outcome as written, unless a runner or the cache control failed.

    ``status`` is (id, text), ``exits`` (id, runner, code), ``os_lines`` (id, line).
    """
    written = status.groupBy("id").agg(F.first(trim_ws(F.col("text"))).alias("written"))
    failed = exits.filter("code <> 0").groupBy("id").agg(F.min_by("code", "runner").alias("code"), F.min("runner").alias("runner"))
    marked = os_lines.filter(F.col("line").contains("Resctrl: Failed")).select("id").distinct().withColumn("marked", F.lit(True))
    all_ = runs.select("id").join(written, "id", "left").join(failed, "id", "left").join(marked, "id", "left")
    said = F.coalesce("written", F.lit("unknown"))
    outcome = (
        F.when(F.lower(said) != "success", said)
        .when(F.col("code").isNotNull(), F.format_string("runner%d exited with code %d", "runner", "code"))
        .when(F.col("marked"), F.lit("resctrl_failed"))
        .otherwise(said)
    )
    return all_.select("id", outcome.alias("status"))


def run_outcomes(runs: DataFrame, status: tuple[DataFrame, DataFrame], exits: tuple[DataFrame, DataFrame], os: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(id, status) for every run, and the issues of the files that tell it: each argument is (text lines, files).

    A run's first readable status file counts and a further one is an issue; so is a runner's file that isn't one whole
    number of 32 bits, which then tells nothing: an earlier one of that runner stays. Files that aren't UTF-8 are issues. Lines of
    ``exits`` have the column ``runner``.
    """
    texts = status[0].groupBy("id", "ord").agg(F.concat_ws("\n", F.array_sort(F.collect_list(F.struct("line_no", "line"))).getField("line")).alias("text"))
    kept, issues = file_verdicts(status[1], F.lit(False), "status")
    written = texts.join(kept.select("id", "ord"), ["id", "ord"], "left_semi")
    said = exits[0].withColumns({"said": trim_ws(F.col("line")), "runner": to_int(F.col("runner"), U32)}).filter("runner is not null")
    first = F.min(F.when(F.col("said") != "", F.struct("line_no", "said"))).alias("first")
    read = said.groupBy("id", "ord", "name", "runner").agg(F.count_if(F.col("said") != "").alias("n"), first)
    code = to_int(F.col("first.said"))
    read = read.withColumn("code", F.when((F.col("n") == 1) & code.between(-(1 << 31), (1 << 31) - 1), code))
    codes = last_wins(read.filter("code is not null"), ["id", "runner"], ["ord"], ["code"])
    odd = read.filter("code is null").select("id", "name", F.coalesce("first.line_no", F.lit(0)).alias("line_no"), F.lit("exit code").alias("field"), F.coalesce("first.said", F.lit("")).alias("value"))
    issues = issues.unionByName(issue(odd, "collector", "status", F.lit("failed to parse for status")))
    for _, files in (exits, os):
        issues = issues.unionByName(file_verdicts(files, F.lit(False), "status", once=False)[1])
    return run_status(runs, written, codes, os[0].select("id", "line")), issues


def extremes(df: DataFrame) -> list[Column]:
    """The least and the greatest of each long column, for ``narrowed``."""
    return [f(F.col(f"`{n}`")).alias(f"{k}{i}") for i, (n, kind) in enumerate(df.dtypes) if kind == "bigint" for k, f in (("least", F.min), ("most", F.max))]


def narrowed(df: DataFrame, found: Row) -> DataFrame:
    """Every long column as the narrowest integer type that holds all its values, given its ``extremes``."""

    def kind(i: int) -> str:
        low, high = found[f"least{i}"] or 0, found[f"most{i}"] or 0
        return next((t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)) if -(1 << bits) <= low and high < 1 << bits), "bigint")

    return df.withColumns({n: F.col(f"`{n}`").cast(kind(i)) for i, (n, k) in enumerate(df.dtypes) if k == "bigint"})


def narrow_ints(df: DataFrame) -> DataFrame:
    """Every long column as the narrowest integer type that holds all its values: one aggregate, then casts."""
    ends = extremes(df)
    return narrowed(df, df.agg(*ends).first()) if ends else df
