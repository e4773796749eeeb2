"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors of cosine c or more lie within squared distance 2 - 2c. The vectors are rotated onto their
principal axes and the axes dealt into low-dimensional blocks. Each block gets a share of the squared distance in
proportion to its variance, so two linked vectors are within budget in at least one block. Each block is
range-joined over a grid on its leading axes, in cells as wide as its radius: a vector is home in one cell and
probes those of the next cells, on one side of its own, that its budget reaches. Pairs within a block's budget are
verified exactly, and belong to the first block that has them within budget, so that the union over blocks
counts each pair once. How many blocks and axes pay is decided by an estimate of the work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spooled
from .components import connected_components, forest, whole_units

#: Numbers of blocks and of a grid's axes to choose from.
BLOCKS, GRID_AXES = (4, 8, 16), (0, 1, 2, 3)
#: What a comparison of two vectors takes, for each and for each of its axes, and what a row takes to be dealt out, in nanoseconds.
PAIR_NS, AXIS_NS, ROW_NS = 1.2, 0.07, 20_000.0
#: Rows and bytes of one side of a unit at most; a vector takes three arrays of 8 bytes a number there.
CHUNK, SIDE_BYTES = 32768, 64 << 20
#: Axes that are rotated together.
TOGETHER = 256
#: Rotated coordinates are whole multiples of 1 / SCALE, so that squared distances are exact in any order of adding.
SCALE = float(1 << 20)
#: What rounding to those multiples may add to a squared distance, for any number of axes up to 4,096; in proportion beyond.
SLACK, SLACK_AXES = 1e-3 / 4, 4096

Rotation = list[np.ndarray]


def balanced(x: np.ndarray) -> np.ndarray:
    """Each row by a power of two, which changes no cosine, so that its greatest number is from a half to one: squares neither vanish nor overflow."""
    _, power = np.frexp(np.abs(x).max(1, initial=0.0))
    return np.ldexp(x, -power[:, None])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of at most ``dim`` numbers, filled up with zeros, as float64."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def _groups(dim: int) -> list[slice]:
    return [slice(at, min(dim, at + TOGETHER)) for at in range(0, dim, TOGETHER)]


def rotation(classes: DataFrame, dim: int) -> tuple[Rotation, np.ndarray, int]:
    """The principal axes (columns) of all unit vectors, for each group of axes, their variances, and how many vectors there are."""

    groups = _groups(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [np.zeros((g.stop - g.start,) * 2) for g in groups], 0
        for batch in batches:
            x = balanced(_matrix(batch["embedding"], dim))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            for t, g in zip(total, groups):
                t += x[:, g].T @ x[:, g]
            n += len(x)
        if n:
            flat = np.concatenate([*(t.ravel() for t in total), [n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "total"])

    # at most TOGETHER * dim + 1 rows, whatever the number of vectors
    sums = classes.select("embedding").mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).toArrow()
    flat = np.zeros(sum((g.stop - g.start) ** 2 for g in groups) + 1)
    flat[sums["at"].to_numpy()] = sums["total"].to_numpy()
    n, at, axes, variance = int(flat[-1]), 0, [], []
    for g in groups:
        size = g.stop - g.start
        square = flat[at : at + size * size].reshape(size, size) / max(n, 1)
        at += size * size
        values, own = np.linalg.eigh((square + square.T) / 2)
        axes.append(own)
        variance.append(np.maximum(values, 0))
    return axes, np.concatenate(variance), n


def turned(x: np.ndarray, axes: Rotation) -> np.ndarray:
    """Unit vectors on the axes, in whole multiples of 1 / SCALE.

    Added axis by axis, so that a vector gets the same numbers in whatever batch it stands: each block's
    join must come to the same verdict on which block a pair belongs to.
    """
    x = balanced(x)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out, at = np.zeros(x.shape), 0
    for own in axes:
        for k in range(len(own)):
            out[:, at : at + len(own)] += x[:, at + k : at + k + 1] * own[k]
        at += len(own)
    return np.rint(out * SCALE)


def dealt(variance: np.ndarray, blocks: int) -> list[np.ndarray]:
    """Axes of each block: by falling variance, there and back, so that blocks have like shares."""
    order = [[] for _ in range(min(blocks, len(variance)))]
    for i, axis in enumerate(np.argsort(-variance, kind="stable").tolist()):
        turn, at = divmod(i, len(order))
        order[at if turn % 2 == 0 else len(order) - 1 - at].append(axis)
    return [np.array(x) for x in order]


def shared_out(variance: np.ndarray, parts: list[np.ndarray], total: float) -> np.ndarray:
    """Each block's budget of the squared distance: in proportion to its variance, none under a thousandth."""
    own = np.array([variance[p].sum() for p in parts])
    own = np.maximum(own, 1e-3 * own.sum()) if own.sum() else np.ones(len(parts))
    return total * own / own.sum()


def plan(variance: np.ndarray, n: int, total: float) -> tuple[list[np.ndarray], np.ndarray, list[int]]:
    """Blocks, budgets and each block's axes of a grid, by the least expected work.

    Coordinates are taken for normal: pairs in one cell or in touching ones are those closer than about one and a
    half radii on each of the grid's axes.
    """
    best: tuple = (math.inf,)
    for count in sorted({min(b, len(variance)) for b in BLOCKS}):
        parts = dealt(variance, count)
        budgets = shared_out(variance, parts, total)
        work, grids = 0.0, []
        for own, budget in zip(parts, budgets):
            met = [math.erf(1.5 * math.sqrt(budget) / (2 * math.sqrt(variance[a]) + 1e-12)) for a in own[: max(GRID_AXES)]]
            costs = [(n * n / 2 * math.prod(met[:g]) * (PAIR_NS + AXIS_NS * len(own)) + n * (3**g + 1) / 2 * ROW_NS, g) for g in GRID_AXES if g <= len(own)]
            work += min(costs)[0]
            grids.append(min(costs)[1])
        best = min(best, (work, parts, budgets, grids), key=lambda x: x[0])
    return best[1:]


def _cells(q: np.ndarray, axes: np.ndarray, budget: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(0, all rows, their home cells), then (1, rows, cells) for each of the next cells that rows reach.

    Of two cells that touch, the one that comes first in order probes the other, so each pair meets once.
    """
    width = math.sqrt(budget) * SCALE * (1 + 1e-9)
    home = np.floor(q[:, axes] / width).astype(np.int64)
    yield 0, np.arange(len(q)), home
    up = (home + 1) * width - q[:, axes]
    down = q[:, axes] - home * width
    for step in product((-1, 0, 1), repeat=len(axes)):
        if step <= (0,) * len(axes):
            continue
        gap = np.zeros(len(q))
        for j, s in enumerate(step):
            gap += (up[:, j] ** 2 if s > 0 else down[:, j] ** 2 if s < 0 else 0.0)
        rows = np.flatnonzero(gap <= budget * SCALE * SCALE * (1 + 1e-6) + 1)
        yield 1, rows, home[rows] + np.array(step)


def _placed(axes: Rotation, parts: list[np.ndarray], budgets: np.ndarray, grids: list[int], dim: int, width: str):
    """For ``mapInArrow``: a row for each vector, block and cell; role 0 is home, 1 a probe. ``width`` is the numbers' own type."""
    most = max(GRID_AXES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, min(2000, SIDE_BYTES // (24 * dim)))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = _matrix(batch["embedding"], dim)
                q = turned(x, axes)
                dims = batch["embedding"].value_lengths()
                plain = pa.array([r.tobytes() for r in x.astype(width)], pa.binary())
                for k, own in enumerate(parts):
                    for role, rows, cells in _cells(q, own[: grids[k]], budgets[k]):
                        n, take = len(rows), pa.array(rows)
                        places = [pa.array(cells[:, j] if j < cells.shape[1] else np.zeros(n, np.int64)) for j in range(most)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, k, np.int32)), dims.take(take).cast(pa.int32()), *places, pa.array(np.full(n, role, np.int32)), batch["cid"].take(take), batch["n"].take(take), plain.take(take)],
                            names=["block", "dims", *(f"c{j}" for j in range(most)), "role", "cid", "n", "plain"],
                        )

    return run


CELL = ["block", "dims", *(f"c{j}" for j in range(max(GRID_AXES)))]
UNIT = [*CELL, "low", "high"]


def _units(placed: DataFrame, chunk: int) -> DataFrame:
    """Cut the home and the probing rows of each cell into chunks, and pair those: adds ``low``, ``high`` and makes ``role`` that in the unit.

    Unit (i, j) compares the home rows of chunk i (role 0) with the probes of chunk j (role 1), and for i <= j with
    the home rows of chunk j (role 2; for i = j those of role 0 among themselves).
    """
    sizes = placed.groupBy(*CELL).agg(*(F.count(F.when(F.col("role") == r, 1)).alias(f"__n{r}") for r in (0, 1))).filter("__n0 > 0 and __n0 + __n1 > 1")
    chunks = F.ceil(F.greatest("__n0", "__n1") / chunk).cast("int")
    joined = placed.join(sizes.select(*CELL, chunks.alias("__chunks")), CELL).withColumn("__own", F.pmod(F.xxhash64("cid"), F.col("__chunks")).cast("int"))
    as_first = F.expr("transform(sequence(0, __chunks - 1), j -> named_struct('low', __own, 'high', j, 'as', 0))")
    as_second = F.expr("transform(filter(sequence(0, __chunks - 1), i -> i < __own), i -> named_struct('low', i, 'high', __own, 'as', 2))")
    as_probe = F.expr("transform(sequence(0, __chunks - 1), i -> named_struct('low', i, 'high', __own, 'as', 1))")
    met = F.explode(F.when(F.col("role") == 0, F.concat(as_first, as_second)).otherwise(as_probe))
    return joined.withColumn("__met", met).select(*CELL, "__met.low", "__met.high", F.col("__met.as").alias("role"), "cid", "n", "plain")


def _verified(axes: Rotation, parts: list[np.ndarray], budgets: np.ndarray, least: float, width: str):
    """For ``mapInArrow`` over rows sorted by unit: each vector's links found there, and a forest of the links."""
    limits, unit = np.floor(budgets * SCALE * SCALE), UNIT
    high, wide = 512, 4096  # rows and columns that are compared at once: a few megabytes

    def owned(k: int, near: list[np.ndarray]) -> np.ndarray:
        out = near[k] <= limits[k]
        for e in range(k):
            out &= near[e] > limits[e]
        return out

    def exact(k: int, h: dict, p: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = h["turned"][i], p["turned"][j]
        cosine = np.einsum("ij,ij->i", h["plain"][i], p["plain"][j]) / (h["norm"][i] * p["norm"][j])
        keep = owned(k, [((x[:, parts[e]] - y[:, parts[e]]) ** 2).sum(1) for e in range(k + 1)]) & (cosine >= least)
        return i[keep], j[keep]

    def pairs(k: int, h: dict, p: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of linked pairs; of one side with itself each pair once."""
        own, alone = parts[k], h is p
        # one product gives h.p - |h|^2 / 2 - |p|^2 / 2, which is minus half the squared distance
        hb, pb = ((x["turned"][:, own] / SCALE).astype(np.float32) for x in (h, p))
        half = [-0.5 * (x * x).sum(1, keepdims=True) for x in (hb, pb)]
        hb = np.concatenate([hb, half[0], np.ones_like(half[0])], axis=1)
        pb = np.concatenate([pb, np.ones_like(half[1]), half[1]], axis=1)
        for at in range(0, len(hb), high):
            for to in range(at if alone else 0, len(pb), wide):
                close = hb[at : at + high] @ pb[to : to + wide].T >= -0.5 * (budgets[k] + 1e-4)
                a, b = np.divmod(np.flatnonzero(close), close.shape[1])
                if len(a) > 0.1 * close.size:  # a dense group: whole products, exact for whole numbers, leave few to gather
                    near = []
                    for e in range(k + 1):
                        x, y = h["turned"][at : at + high, parts[e]], p["turned"][to : to + wide, parts[e]]
                        near.append((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T))
                    cosine = (h["plain"][at : at + high] / h["norm"][at : at + high, None]) @ (p["plain"][to : to + wide] / p["norm"][to : to + wide, None]).T
                    a, b = np.nonzero(owned(k, near) & (cosine >= least - 1e-9))
                a, b = a + at, b + to
                if alone:
                    a, b = a[a < b], b[a < b]
                for cut in range(0, len(a), 1 << 16):
                    i, j = exact(k, h, p, a[cut : cut + (1 << 16)], b[cut : cut + (1 << 16)])
                    if len(i):
                        yield i, j

    def side(rows: dict, role: int) -> dict:
        own = rows["role"] == role
        out = {c: rows[c][own] for c in ("cid", "n")}
        out["plain"] = balanced(np.frombuffer(b"".join(rows["plain"][own]), width).reshape(int(own.sum()), sum(map(len, axes))).astype(np.float64))
        out["turned"] = turned(out["plain"], axes)
        out["norm"] = np.linalg.norm(out["plain"], axis=1)
        return out

    def results(rows: dict) -> pa.RecordBatch | None:
        k, i, j = int(rows["block"][0]), int(rows["low"][0]), int(rows["high"][0])
        if not (rows["role"] == 0).any() or len(rows["role"]) < 2:
            return None
        h = side(rows, 0)
        others = [h if i == j else side(rows, 2), side(rows, 1)] if i <= j else [side(rows, 1)]
        who, far, links = [], [], []
        for p in others:
            if not len(p["cid"]):
                continue
            links_h, links_p = np.zeros(len(h["cid"]), np.int64), np.zeros(len(p["cid"]), np.int64)
            for a, b in pairs(k, h, p):
                links_h += np.bincount(a, weights=p["n"][b], minlength=len(links_h)).astype(np.int64)
                links_p += np.bincount(b, weights=h["n"][a], minlength=len(links_p)).astype(np.int64)
                kept = forest(h["cid"][a], p["cid"][b])
                who.append(h["cid"][a[kept]])
                far.append(p["cid"][b[kept]])
            links += [(h["cid"][links_h > 0], links_h[links_h > 0]), (p["cid"][links_p > 0], links_p[links_p > 0])]
        if not who:
            return None
        a, b = np.concatenate(who), np.concatenate(far)
        kept = forest(a, b)
        ids, counts = (np.concatenate(x) for x in zip(*links))
        every = np.concatenate([a[kept], ids])
        ends = pa.array(np.concatenate([b[kept], np.zeros(len(ids), np.int64)]), mask=np.arange(len(every)) >= len(kept))
        return pa.RecordBatch.from_arrays([pa.array(every), ends, pa.array(np.concatenate([np.zeros(len(kept), np.int64), counts]))], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_units(batches, unit, ["role", "cid", "n", "plain"]):
            for s, e in zip(starts, [*starts[1:], len(rows["cid"])]):
                if (out := results({c: v[s:e] for c, v in rows.items()})) is not None:
                    yield out

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Equal vectors are one class, which stands for its copies: they count as links of each other, and every
    link of the class counts once for each copy on the far side. A vector that is null or zero, or holds a
    null or a number that isn't finite, links with nothing and is its own component. Vectors of different
    lengths never link. Rows that repeat a vec_id are vectors of their own with that id. Null ids don't count
    for the smallest id of a component. Other columns are ignored; an empty table gives an empty one.
    """
    fine = F.coalesce(F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, F.expr("transform(embedding, x -> cast(x as double) + 0.0D)")).alias("embedding"))
    rows = rows.withColumn("hash", _vector_hash())
    classes = rows.filter("embedding is not null").groupBy("hash", "embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # a number for each class, fixed by being written; the hash only deals rows out, vectors are told apart by their numbers
    classes = spooled(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    dim = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    width = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    axes, variance, n = rotation(classes, dim)
    parts, budgets, grids = plan(variance, n, 2 - 2 * least + SLACK * max(1.0, dim / SLACK_AXES))
    schema = ", ".join(["block int, dims int", *(f"c{j} long" for j in range(max(GRID_AXES))), "role int, cid long, n long, plain binary"])
    placed = classes.select("cid", "n", "embedding").mapInArrow(_placed(axes, parts, budgets, grids, dim, width), schema)
    units = _units(placed, max(1, min(CHUNK, SIDE_BYTES // (24 * dim)))).repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = spooled(units.mapInArrow(_verified(axes, parts, budgets, least, width), "a long, b long, links long"), "verified")
    links = found.filter("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cid")
    reached = connected_components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    named = classes.select("cid", "hash", "embedding", "first_id", "n").join(reached, "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    least_id = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = named.join(least_id, "root").join(links, "cid", "left").select("hash", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("fine"))
    out = rows.join(members, ["hash", "embedding"], "left")
    component = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.col("fine").isNull()).alias("kept"))


def _vector_hash() -> F.Column:
    return F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))
