"""Failures as data: issues of runs and files, rows that are withheld for them, and value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KINDS
from ..sources.csvfiles import few

FILE = ["id", "ord", "name"]


#: Code points of a value that an issue tells.
TOLD = 200


def issue(df: DataFrame, stage: str, collector: str | None, message: Column) -> DataFrame:
    """An issue for each row, with the file's name and the place of its failure where ``df`` has them."""

    def own(name: str, kind: str) -> Column:
        return F.col(name).cast(kind).alias(name) if name in df.columns else F.lit(None).cast(kind).alias(name)

    value = F.left(own("value", "string"), F.lit(TOLD)).alias("value")
    return df.select("id", F.lit(stage).alias("stage"), F.lit(collector).cast("string").alias("collector"), own("name", "string"), message.alias("message"), own("line_no", "bigint"), own("field", "string"), value)


def told() -> Column:
    """An issue in words: the file, what happened, and the line, field and value where it happened first. Lines count from 1."""
    place = F.concat_ws(", ", F.concat(F.lit("line "), F.col("line_no") + 1), F.concat(F.lit("field "), "field"), F.concat(F.lit("value '"), "value", F.lit("'")))
    return F.concat(F.coalesce(F.concat("name", F.lit(": ")), F.lit("")), "message", F.when(place != "", F.concat(F.lit(": "), place)).otherwise(""))


def file_verdicts(files: DataFrame, failed: Column, table: str, once: bool = True) -> tuple[DataFrame, DataFrame]:
    """Which of each run's files for a table count: (kept files, issues).

    ``files`` has one row for each (id, ord, name), and perhaps ``fault``: what is wrong with all of the file, and
    where it failed; ``failed`` is whether it failed to parse. With ``once`` the first good file of each run is kept: a bad
    file lets the next one in, and a second good file is an issue. Otherwise all good files are kept.
    """
    fault = F.col("fault") if "fault" in files.columns else F.lit(None).cast("string")
    judged = files.withColumn("__fault", fault).withColumn("__failed", failed | F.col("__fault").isNotNull())
    rank = F.row_number().over(Window.partitionBy("id").orderBy("__failed", "ord")) if once else F.lit(1)
    # whether there is a good file already is asked before a file is read
    late = F.coalesce(F.min(F.when(~F.col("__failed"), F.col("ord"))).over(Window.partitionBy("id")) < F.col("ord"), F.lit(False)) if once else F.lit(False)
    judged = judged.withColumns({"__rank": rank, "__late": late})
    line = F.regexp_extract("__fault", " in line ([0-9]+)$", 1).try_cast("bigint")
    message = F.when(F.col("__late"), "Duplicate file").when(F.col("__fault").isNotNull(), F.regexp_replace("__fault", " in line [0-9]+$", "")).when(F.col("__failed"), "failed to parse").otherwise("Duplicate file")
    wrong = judged.filter("__failed or __rank > 1")
    place = {"line_no": F.coalesce(line, "line_no") if "line_no" in files.columns else line, **{c: F.col(c) for c in ("field", "value") if c in files.columns}}
    wrong = wrong.withColumns({n: F.when(~F.col("__late"), c) for n, c in place.items()})
    return judged.filter("not __failed and __rank = 1").select(*FILE), issue(wrong, "collector", table, F.concat(message, F.lit(f" for {table}")))


def kept_rows(rows: DataFrame, bad: DataFrame, files: DataFrame, table: str, once: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that count, and issues: ``bad`` are the files (id, ord, name) that failed to parse, perhaps with the place.

    ``files`` are all files that rows are of.
    """
    judged = files.join(bad.withColumn("__bad", F.lit(True)), FILE, "left")
    kept, issues = file_verdicts(judged, F.coalesce("__bad", F.lit(False)), table, once)
    return rows_of(rows, files, kept, FILE), issues


def rows_of(rows: DataFrame, files: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the ``kept`` of all ``files``, by those that aren't kept: they are few, as a rule, so that rows, which are many and wide, needn't be shuffled and sorted."""
    left_out, sent = few(files.select(*keys).distinct().join(kept.select(*keys), keys, "left_anti"))
    return rows.join(sent(left_out), keys, "left_anti")


def first_file_wins(routed: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each run's first file, and an issue for every further one."""
    kept, issues = file_verdicts(routed.select(*FILE).distinct(), F.lit(False), table)
    return routed.join(kept, FILE, "left_semi"), issues


def withhold(df: DataFrame, issues: DataFrame, stage: str = "run") -> DataFrame:
    """Rows of the runs without an issue of that stage."""
    return df.join(issues.filter(F.col("stage") == stage).select("id").distinct(), "id", "left_anti")


def assert_unique_tables(made: DataFrame) -> DataFrame:
    """An issue for each run in which two collectors make one table: ``made`` is (id, collector, table)."""
    twice = made.groupBy("id", "table").count().filter("count > 1")
    return issue(twice, "run", None, F.concat(F.lit("table made twice: "), "table"))


def _broken(kind: str, c: Column) -> Column:
    """What is wrong with a value, null if nothing: positive numbers exclude zero of either sign and NaN."""
    if kind == "positive number":
        negative = (c < 0) | ((c == 0) & c.cast("string").startswith("-"))
        return F.when(F.isnan(c), "is not a number").when(negative, "is negative").when(c == 0, "is zero")
    if kind == "positive":
        return F.when(c < 0, "is negative").when(c == 0, "is zero")
    if kind == "natural":
        return F.when(c < 0, "is negative")
    if kind == "byte":
        return F.when(~c.between(0, 255), "is out of range")
    return F.lit(None).cast("string")


def validate(df: DataFrame, rules: dict[str, str] | None = None, on_error: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the first rule that each breaks in ``reason``.

    ``rules`` gives columns a kind of ``schema.KINDS``; absent values break none. With ``on_error='fail'`` the
    first such row ends the job that reads the good ones.
    """
    rules = {c: k for c, k in (KINDS if rules is None else rules).items() if c in df.columns}
    reason = F.coalesce(*(F.concat(F.lit(f"{c} "), _broken(k, F.col(c))) for c, k in rules.items()), F.lit(None).cast("string"))
    judged = df.withColumn("reason", reason)
    rejects = judged.filter("reason is not null")
    if on_error == "fail":
        ok = judged.filter(F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean")).otherwise(F.lit(True)))
    else:
        ok = judged.filter("reason is null")
    return ok.drop("reason"), rejects
