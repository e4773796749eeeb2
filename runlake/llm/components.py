"""Connected components of a graph that no single task could hold, and groups cut into bounded units."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spooled


def forest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Positions of links that join what earlier ones haven't joined: a spanning forest of the links given."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)].tolist(), ends[len(left) :].tolist()
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """The smallest node that each linked node can reach: rows (node, component) for nodes with links.

    Alternates two steps on the links until nothing changes: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours. Both are joins and minima that Spark combines before it
    shuffles, so a node with very many links is no task's burden. Each round is written to the shared folder.
    Links with a null end and from a node to itself are left out; the order and repetition of links don't matter.
    """
    edges = spooled(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        # u > v on every link. Large step: the larger neighbours of a node go to its smallest.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small step: the smaller neighbours of a node, and the node, go to the smallest of them.
        large = spooled(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = spooled(small, "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        state = tuple(now)


def in_units(rows: DataFrame, keys: list[str], spread: str, most: int) -> DataFrame:
    """Cut each group of two or more rows into chunks, and pair the chunks: adds ``low``, ``high`` and ``side``.

    Every two rows of a group meet in at least one unit (keys, low, high): those of different chunks in that of both
    chunks (``side`` 0 and 1), those of one chunk in its own (``side`` 0 only). A unit holds two chunks of about
    ``most`` rows, whatever the group's size. ``spread`` is a column of well mixed 64-bit values.
    """
    sizes = rows.groupBy(*keys).count().filter("count > 1").select(*keys, F.ceil(F.col("count") / most).cast("int").alias("__chunks"))
    chunk = F.pmod(F.col(spread), F.col("__chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    return (
        rows.join(sizes, keys)
        .withColumn("__own", chunk)
        .withColumn("__other", other)
        .withColumn("low", F.least("__own", "__other"))
        .withColumn("high", F.greatest("__own", "__other"))
        .withColumn("side", (F.col("__own") > F.col("__other")).cast("int"))
        .drop("__chunks", "__own", "__other")
    )


def whole_units(batches: Iterator[pa.RecordBatch], unit: list[str], others: list[str]) -> Iterator[tuple[dict[str, np.ndarray], list[int]]]:
    """Of rows sorted by the columns ``unit``: the columns of some whole units, and where each starts.

    The last unit of a batch waits for the next batch. A unit is bounded, so this is too.
    """
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        now = {c: batch[c].to_numpy(zero_copy_only=False) for c in (*unit, *others)}
        if held:
            now = {c: np.concatenate([held[c], v]) for c, v in now.items()}
        if not batch.num_rows:
            continue
        change = np.logical_or.reduce([now[c][1:] != now[c][:-1] for c in unit])
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        if len(starts) > 1:
            yield {c: v[: starts[-1]] for c, v in now.items()}, starts[:-1]
        held = {c: v[starts[-1] :] for c, v in now.items()}
    if held:
        yield held, [0]
