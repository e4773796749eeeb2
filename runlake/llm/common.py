"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Spark's reader opens the path, so any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the one that all executors share; without one, an error on a cluster."""
    return shared_folder(spark, label)


def spooled(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def by_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: ``make`` runs once in each task and returns the work for one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return run


def smaller_batches(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``most_bytes`` of ``column`` (one long row may hold more)."""
    start, held = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch[column]).to_pylist()):
        if held and held + (n or 0) > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)
