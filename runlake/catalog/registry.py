"""Where queries are registered, and how the given tables are rendered as the text that operators read.

The given tables hold no archives, so each query writes its table's rows as the lines of a log or export,
for all rows and with Spark's expressions, and has the operator read them. The oracle computes the
same from the columns and never sees the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        ORACLES[name] = oracle
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, which is what the oracles' tables hold."""
    return df.withColumns({n: F.col(f"`{n}`").cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the texts that many lines hold: ``clock`` and ``number``."""
    return table(spark, sf_dir, "events").withColumns({"clock": F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") || '-0400'"), "number": F.expr("cast(cast(value as decimal(12,3)) as string)")})


def lines(df: DataFrame, text: str | Column, name: str, id_: str = "user_id", line_no: str = "event_id", *more: str) -> DataFrame:
    """Each row as a line (or some, where ``text`` is an array) of its run's file ``name``."""
    made = F.expr(text) if isinstance(text, str) else text
    out = df.select(F.expr(id_).cast("bigint").alias("id"), F.lit(0).alias("ord"), F.expr(name).alias("name"), F.expr(line_no).cast("bigint").alias("line_no"), made.alias("line"), *more)
    if dict(out.dtypes)["line"].startswith("array"):
        out = out.withColumn("line", F.explode("line"))
    return out.withColumn("is_last", F.lit(False))


#: DuckDB: the instant of an event as written, and its number as read.
CLOCK = "date_trunc('millisecond', ts) + INTERVAL 4 HOUR"
