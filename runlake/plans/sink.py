"""The lake: each table a Parquet dataset with a partition for each collection."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.reduce import extremes, narrowed
from ..operators.selection import fan_out

# Bytes in memory of a file's rows at most, rows of a row group, and zstandard's level.
FILE_BYTES, GROUP_ROWS, LEVEL = 750 << 20, 1_000_000, 18
#: Tables that are written at a time.
SIDE_BY_SIDE = 4

T = TypeVar("T")


def reset_collections(spark: SparkSession, base: str, names: list[str], kept: list[str] | None = None) -> None:
    """Delete what earlier runs wrote of these collections, but for tables named in ``kept``, and nothing of others."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in names:
        for found in fs.globStatus(path(f"{base}/*/collection={name}")) or []:
            if found.getPath().getParent().getName() not in (kept or ()):
                fs.delete(found.getPath(), True)


def width(df: DataFrame) -> Column:
    """A row's bytes in memory: eight for each number, one for a truth value, and those of its texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n, kind in df.dtypes if kind in ("string", "binary")]
    return sum(texts, F.lit(sum(1 if kind == "boolean" else 8 for _, kind in df.dtypes))).cast("bigint")


def _as_files(rows: DataFrame) -> DataFrameWriter:
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", LEVEL)
    # pages end by their bytes alone: to set up this level takes tens of milliseconds a page, far more than to compress a small one
    return writer.option("parquet.block.row.count.limit", GROUP_ROWS).option("parquet.page.row.count.limit", GROUP_ROWS).partitionBy("collection")


def numbered(written: DataFrame, file_bytes: int, widest: int) -> tuple[DataFrame, list[str], int]:
    """Rows read from files with ``__to``, the number of the file they go to, the collections that have rows, and how many files there are.

    Running bytes of each collection, in the order in which the rows were written, tell the number: those of whole files by a
    table of files, those within a file by a window over it. A file so holds at most ``file_bytes``, unless a single row has more than half of them.
    """
    room = max(file_bytes - widest, file_bytes // 2, 1)
    placed = written.withColumns({"__width": width(written), "__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})
    files = placed.groupBy("collection", "__file").agg(F.sum("__width").alias("bytes"))
    totals = {r["collection"]: r["bytes"] for r in files.groupBy("collection").agg(F.sum("bytes").alias("bytes")).collect()}  # a row for each collection
    names, first, at = sorted(totals), {}, 0
    for name in names:
        first[name], at = at, at + totals[name] // room + 1
    base = F.element_at(F.create_map(*(F.lit(x) for pair in first.items() for x in pair)), F.col("collection"))
    if all(total <= file_bytes for total in totals.values()):
        at, base = len(names), F.element_at(F.create_map(*(F.lit(x) for pair in zip(names, range(len(names))) for x in pair)), F.col("collection"))
        return placed.withColumn("__to", base.cast("int")).drop("__width", "__file", "__row"), names, at
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("collection").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select("collection", "__file", before.alias("__start"))
    within = F.coalesce(F.sum("__width").over(Window.partitionBy("collection", "__file").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    to = base + F.floor((F.col("__start") + F.col("__within")) / room)
    rows = placed.join(starts, ["collection", "__file"]).withColumn("__within", within).withColumn("__to", to.cast("int"))
    return rows.select(*written.columns, "__to"), names, at


def write_table(df: DataFrame, table: str, base: str, narrow: bool = False, file_bytes: int = FILE_BYTES) -> tuple[StructType, list[str]]:
    """Write rows that have a column ``collection``; partitions of other collections stay. Returns the schema written and the collections with rows.

    What makes the rows runs once: they are written as they are, and measured while that is done. With ``narrow`` integers take
    the least width for the whole table. A file holds at most ``file_bytes`` of rows as they are in memory, and a
    collection's rows go to as few files as that allows. If nothing narrows and each collection is one file, what was written first is the table.
    """
    spark, wide, seen = df.sparkSession, f"{base}/_wide/{table}-{uuid.uuid4().hex}", Observation()
    ends = extremes(df) if narrow else []
    measures = [F.count(F.lit(1)).alias("n"), *(F.coalesce(f(width(df)), F.lit(0)).alias(n) for f, n in ((F.sum, "bytes"), (F.max, "widest"))), *ends]
    if ends:
        df.observe(seen, *measures).write.parquet(wide)
    else:
        _as_files(df.hint("rebalance", F.col("collection")).observe(seen, *measures)).parquet(wide)
    found = seen.get
    schema = (narrowed(df.limit(0), found) if ends else df).schema
    names: list[str] = []
    if found["n"] and not ends and found["bytes"] <= file_bytes:
        names = moved(spark, wide, f"{base}/{table}")
    elif found["n"]:
        rows, names, files = numbered(spark.read.schema(df.schema).parquet(wide), file_bytes, found["widest"])
        rows = rows.repartitionById(files, "__to").drop("__to")
        rows = narrowed(rows, found) if ends else rows
        _as_files(rows.select(*df.columns)).option("partitionOverwriteMode", "dynamic").parquet(f"{base}/{table}")
    delete(spark, wide)
    return schema, names


def moved(spark: SparkSession, made: str, table: str) -> list[str]:
    """Put the collections' folders of ``made`` in place of those of ``table``; returns the collections."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(table))
    names = []
    for found in fs.globStatus(path(f"{made}/collection=*")) or []:
        name = found.getPath().getName()
        fs.delete(path(f"{table}/{name}"), True)
        if not fs.rename(found.getPath(), path(f"{table}/{name}")):
            raise OSError(f"cannot move {found.getPath()} to {table}")
        names.append(name.removeprefix("collection="))
    return names


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def side_by_side(spark: SparkSession, jobs: dict[str, Callable[[], T]], at_once: int = SIDE_BY_SIDE) -> dict[str, T]:
    """What each job returns; some run at a time, in pools of their own where the scheduler is fair. The first failure ends the rest."""

    def run(name: str) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return jobs[name]()

    with ThreadPoolExecutor(at_once) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in jobs}
        done, _ = wait(begun.values(), return_when=FIRST_EXCEPTION)
        if any(job.exception() for job in done):
            pool.shutdown(cancel_futures=True)
        for job in done:
            job.result()
        return {name: job.result() for name, job in begun.items()}


def fill_empty(spark: SparkSession, schema: StructType, table: str, base: str, names: list[str]) -> None:
    """Give each collection without rows of a table a file that holds its schema, in place of what it had: empty isn't absent."""
    plain = StructType([f for f in schema.fields if f.name != "collection"])
    for name in names:
        spark.createDataFrame([], plain).write.mode("overwrite").parquet(f"{base}/{table}/collection={name}")


def write_tables(tables: dict[str, DataFrame], selected: DataFrame, base: str, drop_tables: tuple[str, ...] = (), narrow: bool = False, collections: list[str] | None = None, at_once: int = SIDE_BY_SIDE) -> list[str]:
    """Write each table to the collections of its runs; dropped tables are never computed. Returns the names written.

    Of ``collections``, those without rows get an empty table. ``at_once`` tables are written side by side.
    """
    kept, spark = sorted(set(tables) - set(drop_tables)), selected.sparkSession

    def write(name: str) -> None:
        schema, names = write_table(fan_out(tables[name], selected), name, base, narrow)
        fill_empty(spark, schema, name, base, sorted(set(collections or ()) - set(names)))

    side_by_side(spark, {name: lambda name=name: write(name) for name in kept}, at_once)
    return kept
