"""Hard negatives for contrastive training, by a multiway tree of hyperplanes whose split points know each other's subtrees.

Vectors are whole numbers, scores their inner products. With one more coordinate that fills each vector up to the
longest one's length, and zero for an anchor, a window of scores is a ring of distances around the anchor. A node of the tree has
some split points, and each vector goes to the nearest. Each split point also keeps, for each sibling's
subtree, the least and the greatest distance to the vectors there. A ring that doesn't reach from a split point into that range
rules the sibling out (both by the triangle inequality), so an anchor visits only the leaves that no
split point rules out, and what is found there is compared exactly. Nothing is missed.

The tree is laid out over a bounded sample; every vector is put into it, and the ranges are those of all vectors. The sample's own
scores give each anchor a first bound, which narrows its rings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spooled
from .components import whole_units

#: Vectors that the tree is laid out over at most, split points of a node, vectors of a leaf as far as the sample goes.
SAMPLE, FANOUT, LEAF, LEAST_OF_SAMPLE = 16384, 16, 256, 16
#: Bytes of a leaf's vectors in one unit (eight for each number), anchors of a unit, and anchors that are compared at once.
SIDE_BYTES, ANCHORS, TILE = 64 << 20, 1 << 16, 256
#: Positives of an anchor and negatives of each positive.
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between so many hundredths of its positive's.
LOW, HIGH = 30, 90
NO_ID = (1 << 63) - 1
#: No score goes beyond it.
FAR = 1 << 62

UNIT = ["leaf", "chunk", "deal"]
SIDES = "leaf int, chunk int, deal int, role int, row long, id long, missing int, label long, vec binary, lows binary, highs binary"


@dataclass
class Tree:
    """Nodes with split points and their children (a node's number, or ~leaf), and for each pair (point, sibling) a range of distances."""

    length: float
    kind: str
    dim: int
    points: list[np.ndarray] = field(default_factory=list)
    children: list[np.ndarray] = field(default_factory=list)
    least: list[np.ndarray] = field(default_factory=list)
    most: list[np.ndarray] = field(default_factory=list)
    leaves: int = 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.length**2 - np.einsum("ij,ij->i", x, x)))
        return np.column_stack([x, rest])

    def away(self, x: np.ndarray, node: int) -> np.ndarray:
        """Distances of lifted vectors to a node's split points; all of them have one length."""
        return np.sqrt(np.maximum(0.0, 2 * self.length**2 - 2 * (x @ self.points[node].T)))

    def paths(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each node that vectors pass: which do, their distances to its split points, the place of the nearest."""
        x = self.lifted(x)
        open_ = [(0, np.arange(len(x)))] if self.points else []
        while open_:
            node, rows = open_.pop()
            away = self.away(x[rows], node)
            nearest = away.argmin(1)
            yield node, rows, away, nearest
            for place, child in enumerate(self.children[node].tolist()):
                own = rows[nearest == place]
                if child >= 0 and len(own):
                    open_.append((child, own))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int32)
        for node, rows, _, nearest in self.paths(x):
            leaf[rows] = ~self.children[node][nearest]  # overwritten further down where the child is a node
        return leaf

    def reached(self, q: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, leaf) for each leaf that may hold a score within one of the anchor's windows; a window whose low is above its high is none."""
        square = np.einsum("ij,ij->i", q, q)[:, None] + self.length**2
        slack = 1e-6 * (np.sqrt(square) + self.length) + 1e-9
        outer = np.sqrt(np.maximum(0.0, square - 2.0 * lows)) + slack
        inner = np.sqrt(np.maximum(0.0, square - 2.0 * highs)) - slack
        there = lows <= highs
        anchors = np.flatnonzero(there.any(1))
        if not self.points:
            return anchors, np.zeros(len(anchors), np.int32)
        found, open_ = [], [(0, anchors)]
        while open_:
            node, rows = open_.pop()
            away = np.sqrt(np.maximum(0.0, square[rows] - 2 * (q[rows] @ self.points[node][:, :-1].T)))[:, :, None]
            may = np.zeros((len(rows), len(self.children[node])), bool)
            for w in range(lows.shape[1]):
                far, near = outer[rows, w, None, None], inner[rows, w, None, None]
                meets = (self.most[node] >= np.maximum(away - far, near - away)) & (self.least[node] <= away + far)
                may |= meets.all(1) & there[rows, w, None]
            for place, child in enumerate(self.children[node].tolist()):
                own = rows[may[:, place]]
                if len(own):
                    if child >= 0:
                        open_.append((child, own))
                    else:
                        found.append((own, np.full(len(own), ~child, np.int32)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found))


def unpacked(column, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), dim).astype(np.float64)


def grown(x: np.ndarray, n: int, length: float, kind: str) -> Tree:
    """A tree over a sample of ``n`` vectors: at each node split points that lie far apart, each the start of a subtree."""
    tree = Tree(length, kind, x.shape[1])
    x = tree.lifted(x)
    least = max(LEAST_OF_SAMPLE, math.ceil(LEAF * len(x) / max(n, 1)))
    leaves = 0
    open_: list[tuple[np.ndarray, tuple[int, int] | None]] = [(np.arange(len(x)), None)]
    while open_:
        rows, above = open_.pop()
        fanout, own, nearest = min(FANOUT, len(rows) // least), [], np.zeros(0)
        if fanout >= 2:
            some = rows[: 8 * fanout]  # the sample is in no order
            gap = np.full(len(some), np.inf)
            while len(own) < fanout and gap.max() > 0:
                own.append(int(gap.argmax()))
                gap = np.minimum(gap, ((x[some] - x[some[own[-1]]]) ** 2).sum(1))
            nearest = (2 * length**2 - 2 * (x[rows] @ x[some[own]].T)).argmin(1)
        if len(own) < 2 or np.bincount(nearest).max() == len(rows):
            here, leaves = ~leaves, leaves + 1
        else:
            here = len(tree.points)
            tree.points.append(x[some[own]])
            tree.children.append(np.zeros(len(own), np.int64))
            open_ += [(rows[nearest == place], (here, place)) for place in range(len(own))]
        if above:
            tree.children[above[0]][above[1]] = here
    tree.leaves = leaves
    return tree


def prepared(vectors: DataFrame) -> tuple[DataFrame, int, str]:
    """The rows that take part, with whole numbers packed as ``vec``, how many numbers a vector has, and their type."""
    fine = F.coalesce(F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"), F.lit(False))
    label, id_ = F.col("label").cast("long"), F.col("vec_id").cast("long")
    rows = vectors.filter(fine & label.isNotNull()).select(id_.alias("vec_id"), F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    ends = rows.agg(F.max(F.size("embedding")), F.max(F.greatest(F.abs(F.array_max("embedding")), F.abs(F.array_min("embedding"))))).first()
    dim, peak = max(1, ends[0] or 1), 256 * (ends[1] or 0.0) + 1
    if 100 * dim * peak * peak >= 2**63:
        raise ValueError("scores of these vectors go beyond 64 bits")
    kind = "<i2" if peak < 1 << 15 else "<i4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["embedding"]
            x = np.zeros((len(column), dim))
            x[np.arange(dim)[None, :] < column.value_lengths().to_numpy()[:, None]] = column.flatten().to_numpy()
            x = np.floor(256 * x)
            vec = [r.tobytes() for r in x.astype(kind)]
            missing = batch["vec_id"].is_null().cast(pa.int32())
            square = pa.array(np.einsum("ij,ij->i", x, x).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch["vec_id"].fill_null(NO_ID), missing, batch["label"], pa.array(vec, pa.binary()), square], names=["id", "missing", "label", "vec", "square"])

    made = rows.mapInArrow(run, "id long, missing int, label long, vec binary, square long")
    return spooled(made.withColumn("row", F.monotonically_increasing_id()), "vectors"), dim, kind


def ranges(placed: DataFrame, tree: Tree) -> None:
    """Fill in the ranges of all vectors: for each node as many as the square of its split points, so a bounded table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [(np.full((len(c),) * 2, np.inf), np.full((len(c),) * 2, -np.inf)) for c in tree.children]
        for batch in batches:
            for node, _, away, nearest in tree.paths(unpacked(batch["vec"].to_pylist(), tree.kind, tree.dim)):
                for place in np.unique(nearest):
                    own = away[nearest == place]
                    ends[node][0][:, place] = np.minimum(ends[node][0][:, place], own.min(0))
                    ends[node][1][:, place] = np.maximum(ends[node][1][:, place], own.max(0))
        for node, (least, most) in enumerate(ends):
            i, j = np.nonzero(np.isfinite(least))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(least[i, j]), pa.array(most[i, j])], names=["node", "i", "j", "least", "most"])

    tree.least = [np.full((len(c),) * 2, np.inf) for c in tree.children]
    tree.most = [np.full((len(c),) * 2, -np.inf) for c in tree.children]
    found = placed.select("vec").mapInArrow(run, "node int, i int, j int, least double, most double").groupBy("node", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    for r in found.collect():
        tree.least[r["node"]][r["i"], r["j"]], tree.most[r["node"]][r["i"], r["j"]] = r["least"], r["most"]


def best_of(scores: np.ndarray, may: np.ndarray, most: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` highest scores of each row where ``may``; of equal ones those first in ``order``."""
    i, j = np.nonzero(may)
    if len(i) > 4 * most * len(scores) and scores.shape[1] > most:
        masked = np.where(may, scores, scores.dtype.type(-FAR))
        last = np.partition(masked, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most]
        i, j = np.nonzero(may & (masked >= last[:, None]))
    sort = np.lexsort((order[j], -scores[i, j], i))
    i, j = i[sort], j[sort]
    rank = np.arange(len(i)) - np.searchsorted(i, i, "left")
    return i[rank < most], j[rank < most]


def exact(x: np.ndarray, y: np.ndarray, square: float) -> np.ndarray:
    """Inner products of whole numbers: no partial sum goes beyond the greatest squared length, so floats hold them as far as theirs do."""
    if square < 1 << 24:
        return (x.astype(np.float32) @ y.astype(np.float32).T).astype(np.float64)
    if square < 1 << 53:
        return x @ y.T
    return x.astype(np.int64) @ y.astype(np.int64).T


def windows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Lows and highs of each anchor's windows: of positives any score, of negatives those between the hundredths of each positive's."""
    if "scores" not in batch.schema.names:
        return np.full((batch.num_rows, 1), -FAR), np.full((batch.num_rows, 1), FAR)
    lows, highs = np.ones((batch.num_rows, POSITIVES), np.int64), np.zeros((batch.num_rows, POSITIVES), np.int64)
    for i, own in enumerate(batch["scores"].to_pylist()):
        lows[i, : len(own)], highs[i, : len(own)] = [-(-LOW * s // 100) for s in own], [HIGH * s // 100 for s in own]
    return lows, highs


def dealt(tree: Tree, sample: dict[str, np.ndarray], chunks: np.ndarray, deals: int, same: bool, most: int):
    """For ``mapInArrow`` over anchors: a row for each unit in which an anchor may find what it looks for."""
    known = sample["vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                batch = whole.slice(at, TILE)
                q = unpacked(batch["vec"].to_pylist(), tree.kind, tree.dim)
                lows, highs = windows_of(batch)
                row, label = batch["row"].to_numpy(), batch["label"].to_numpy()
                if len(known):
                    scores = exact(q, known, tree.length**2)
                    fit = ((label[:, None] == sample["label"]) == same) & (row[:, None] != sample["row"])
                    for w in range(lows.shape[1]):
                        inside = np.where(fit & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None]), scores, scores.dtype.type(-FAR))
                        if inside.shape[1] >= most:
                            found = np.partition(inside, inside.shape[1] - most, axis=1)[:, inside.shape[1] - most]
                            lows[:, w] = np.maximum(lows[:, w], found.astype(np.int64))
                anchor, leaf = tree.reached(q, lows, highs)
                times = chunks[leaf]
                anchor, leaf = np.repeat(anchor, times), np.repeat(leaf, times)
                chunk = np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
                take = pa.array(anchor)
                packed = [pa.array([r.tobytes() for r in x.astype("<i8")], pa.binary()).take(take) for x in (lows, highs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int32)), pa.array(chunk.astype(np.int32)), pa.array((row[anchor] % deals).astype(np.int32)), pa.array(np.ones(len(anchor), np.int32)), *(batch[c].take(take) for c in ("row", "id", "missing", "label", "vec")), *packed],
                    names=[c.split()[0] for c in SIDES.split(", ")],
                )

    return run


def compared(tree: Tree, same: bool, most: int):
    """For ``mapInArrow`` over rows sorted by unit: (row, other, missing, score) of what each anchor finds in a unit."""

    def results(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, asks = rows["role"] == 0, np.flatnonzero(rows["role"] == 1)
        if not own.any():
            return
        x, label, row, id_, missing = unpacked(rows["vec"][own], tree.kind, tree.dim), *(rows[c][own] for c in ("label", "row", "id", "missing"))
        order = np.empty(len(id_), np.int64)
        order[np.lexsort((id_, missing))] = np.arange(len(id_))
        step = max(1, min(TILE, (32 << 20) // (8 * len(x))))
        for at in range(0, len(asks), step):
            of = asks[at : at + step]
            scores = exact(unpacked(rows["vec"][of], tree.kind, tree.dim), x, tree.length**2)
            fit = ((rows["label"][of][:, None] == label) == same) & (rows["row"][of][:, None] != row)
            lows, highs = (np.frombuffer(b"".join(rows[c][of]), "<i8").reshape(len(of), -1) for c in ("lows", "highs"))
            parts = [best_of(scores, fit & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None]), most, order) for w in range(lows.shape[1])]
            found = np.unique(np.concatenate([i * len(x) + j for i, j in parts]))
            i, j = np.divmod(found, len(x))
            yield pa.RecordBatch.from_arrays([pa.array(rows["row"][of][i]), pa.array(id_[j]), pa.array(missing[j]), pa.array(scores[i, j].astype(np.int64))], names=["row", "other", "missing", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_units(batches, UNIT, ["role", "row", "id", "missing", "label", "vec", "lows", "highs"]):
            for s, e in zip(starts, [*starts[1:], len(rows["row"])]):
                yield from results({c: v[s:e] for c, v in rows.items()})

    return run


class Search:
    """The tree over all vectors, ready to be asked."""

    def __init__(self, vectors: DataFrame):
        self.rows, dim, kind = prepared(vectors)
        n, square = self.rows.agg(F.count(F.lit(1)), F.max("square")).first()
        # at most SAMPLE rows, whatever the number of vectors
        few = self.rows.orderBy(F.xxhash64("row")).limit(SAMPLE).select("row", "label", "vec").toArrow()
        self.sample = {"row": few["row"].to_numpy(), "label": few["label"].to_numpy(), "vec": unpacked(few["vec"].to_pylist(), kind, dim)}
        self.tree = tree = grown(self.sample["vec"], n, math.sqrt(square or 0), kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.append_column("leaf", pa.array(tree.leaf_of(unpacked(batch["vec"].to_pylist(), kind, dim))))

        self.placed = spooled(self.rows.drop("square").mapInArrow(run, "id long, missing int, label long, vec binary, row long, leaf int"), "placed")
        ranges(self.placed, tree)
        sizes = np.zeros(tree.leaves, np.int64)
        for r in self.placed.groupBy("leaf").count().collect():  # a row for each leaf
            sizes[r["leaf"]] = r["count"]
        self.chunks = np.maximum(1, -(-sizes // max(1, SIDE_BYTES // (8 * dim))))
        self.anchors = self.placed.filter("missing = 0 and id % 100 = 0")
        self.deals = max(1, math.ceil(self.anchors.count() / ANCHORS))

    def ask(self, anchors: DataFrame, same: bool, most: int) -> DataFrame:
        """Candidates (row, other, missing, score) of each anchor: the ``most`` best of every unit within each of its windows are among them."""
        asked = anchors.mapInArrow(dealt(self.tree, self.sample, self.chunks, self.deals, same, most), SIDES)
        of_leaf = F.element_at(F.array(*(F.lit(int(c)) for c in self.chunks)), F.col("leaf") + 1)
        mine = self.placed.withColumn("chunk", F.pmod(F.xxhash64("row"), of_leaf).cast("int")).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(self.deals - 1))))
        nothing = F.lit(None).cast("binary")
        mine = mine.select("leaf", "chunk", "deal", F.lit(0).alias("role"), "row", "id", "missing", "label", "vec", nothing.alias("lows"), nothing.alias("highs"))
        # a number of partitions of its own: much work on few bytes, which adaptive execution would merge
        parts = max(1, min(int(self.chunks.sum()) * self.deals, 4 * int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        units = mine.unionByName(asked).repartition(parts, *UNIT).sortWithinPartitions(*UNIT, "role")
        return units.mapInArrow(compared(self.tree, same, most), "row long, other long, missing int, score long")


def _first(found: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "missing", "other")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= most)


def _id(other: str, missing: str) -> Column:
    return F.when(F.col(missing) == 0, F.col(other))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """Negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Rows that repeat an id
    are rows of their own: each is an anchor by itself and another row to its twin. Rows without an id are no
    anchors; among equal scores they come last. A shorter vector counts as filled up with zeros. Other columns are ignored; an
    empty table gives an empty one. Vectors whose scores don't fit into 64 bits are an error.
    """
    search = Search(vectors)
    found = _first(search.ask(search.anchors, True, POSITIVES), ["row"], POSITIVES, "k")
    positives = spooled(found.select("row", "k", F.col("other").alias("positive"), F.col("missing").alias("unnamed"), F.col("score").alias("positive_score")), "positives")
    asking = search.anchors.join(positives.groupBy("row").agg(F.array_sort(F.collect_list("positive_score")).alias("scores")), "row")
    candidates = search.ask(asking, False, NEGATIVES)
    pairs = candidates.join(positives, "row").filter((LOW * F.col("positive_score") <= 100 * F.col("score")) & (100 * F.col("score") <= HIGH * F.col("positive_score")))
    ranked = _first(pairs, ["row", "k"], NEGATIVES, "rank")
    named = search.anchors.select("row", F.col("id").alias("anchor_id"))
    return ranked.join(named, "row").select("anchor_id", _id("positive", "unnamed").alias("positive_id"), F.col("rank").cast("int").alias("rank"), _id("other", "missing").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
