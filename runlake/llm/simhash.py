"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints of 64 bits link if at most ``radius`` bits differ. The bits are dealt into partitions, and each
partition gets a threshold t of its own. If the numbers t + 1 sum to radius + 1, two linked fingerprints
differ in at most t bits of some partition, so that partition finds them. Correlated bits are put into one
partition, since they tell candidates apart no better than one of them; the thresholds come from a dynamic
program over the estimated number of candidates, and partitions may be left out (t = -1).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smaller_batches, spooled, text_or_empty
from .components import connected_components, forest, in_units, whole_units
from .shingle_links import band_keys, root_links, shingles

BITS = 64
#: Rows of one chunk of a group; a unit compares two chunks.
CHUNK = 256
#: What a signature row costs to deal out, counted in comparisons of two fingerprints.
ROW_COST = 200.0
UNIT = ["probe", "key", "low", "high"]

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, width: int = 3) -> int:
    """SimHash over the XXH64 (seed 42) of each run of ``width`` words; 0 for a text without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    n, ones = 0, np.zeros(BITS, dtype=np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8")
    for part in np.array_split(hashes, max(1, len(hashes) >> 14)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, carry: str | None = None, sketch: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) and the string column ``carry`` of each row; a null text counts as an empty one.

    With ``sketch`` also n_shingles and band_keys, by which texts of similar shingles are found.
    """
    more = [] if carry is None else [carry]
    sketched = ["n_shingles", "band_keys"] if sketch else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in smaller_batches(whole, "text", 8 << 20)):
            prints = np.fromiter((fingerprint(t.as_py(), width) for t in batch["text"]), dtype=np.uint64, count=batch.num_rows)
            found = []
            if sketch:
                hashes = [shingles(t.as_py()) for t in batch["text"]]
                found = [pa.array([len(x) for x in hashes], pa.int64()), pa.array([band_keys(x) for x in hashes], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64)), *(batch[c] for c in more), *found], names=["doc_id", "fp", *more, *sketched])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *(F.col(c) for c in more)]
    return docs.select(*columns).mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"`{c}` string" for c in more), *(["n_shingles long, band_keys array<long>"] if sketch else [])]))


def agreement(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for bits i and j how many of them have both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            at = np.arange(BITS * BITS + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(both.astype(np.int64).ravel(), n))], names=["at", "n"])

    sums = distinct.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4,097 rows at most
    flat = np.zeros(BITS * BITS + 1)
    for row in sums:
        flat[row["at"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def chances(n: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chance that two fingerprints agree at bit i, and that they agree at bits i and j."""
    one = np.diag(both) / max(n, 1)
    pair = both / max(n, 1)
    cells = [pair, one[:, None] - pair, one[None, :] - pair, 1 - one[:, None] - one[None, :] + pair]
    return one**2 + (1 - one) ** 2, sum(np.clip(c, 0, 1) ** 2 for c in cells)


def partitions(both_agree: np.ndarray, alone: np.ndarray, count: int) -> list[list[int]]:
    """Deal the bits into ``count`` partitions of near equal width, each grown by the bit most correlated with it."""
    gain = np.abs(both_agree / np.maximum(np.outer(alone, alone), 1e-12) - 1)
    np.fill_diagonal(gain, 0)
    free, out = set(range(BITS)), []
    for k in range(count):
        width = math.ceil(len(free) / (count - k))
        own = [max(free, key=lambda i: (gain[i, sorted(free)].sum(), -i))]
        free.discard(own[0])
        while len(own) < width:
            best = max(free, key=lambda i: (gain[i, own].max(), -i))
            own.append(best)
            free.discard(best)
        out.append(sorted(own))
    return out


def expected(bits: list[int], threshold: int, n: int, alone: np.ndarray, both_agree: np.ndarray) -> float:
    """Comparisons and rows of a partition: pairs that differ in at most ``threshold`` of its bits, along a chain of
    the bits where each agrees given the one before it."""
    if threshold < 0:
        return 0.0
    given = [alone[bits[0]]] + [both_agree[a, b] / max(alone[a], 1e-12) for a, b in zip(bits, bits[1:])]
    chance = np.zeros(threshold + 1)
    chance[0] = 1.0
    for p in np.clip(given, 1e-6, 1 - 1e-6):
        chance[1:] = chance[1:] * p + chance[:-1] * (1 - p)
        chance[0] *= p
    signatures = math.comb(len(bits), threshold)
    return signatures * (max(n, 1) * ROW_COST + chance[0] * n * n / 2) + chance[1:].sum() * n * n / 2


def plan(n: int, both: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """The partitions and thresholds of least expected work: the dynamic program, for each number of partitions."""
    alone, both_agree = chances(n, both)
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for count in range(1, radius + 2):
        parts = partitions(both_agree, alone, count)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}  # sum of t + 1 so far: least work
        for bits in parts:
            after: dict[int, tuple[float, tuple[int, ...]]] = {}
            for spent, (work, chosen) in table.items():
                for t in range(-1, radius + 1 - spent):
                    new = (work + expected(bits, t, n, alone, both_agree), (*chosen, t))
                    after[spent + t + 1] = min(after.get(spent + t + 1, (math.inf, ())), new)
            table = after
        work, chosen = table[radius + 1]
        best = min(best, (work, [(b, t) for b, t in zip(parts, chosen) if t >= 0]), key=lambda x: x[0])
    return best[1]


def _signatures(parts: list[tuple[list[int], int]]) -> F.Column:
    """The masks that leave t bits of each partition out; fingerprints that agree under one are candidates."""
    from itertools import combinations

    masks = []
    for k, (bits, t) in enumerate(parts):
        for out in combinations(bits, t):
            mask = sum(1 << b for b in bits if b not in out)
            masks.append((k, mask - (1 << 64) if mask >> 63 else mask))
    return F.array(*(F.struct(F.lit(i).alias("probe"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")) for i, (_, mask) in enumerate(masks)))


def _links(radius: int):
    """For ``mapInArrow`` over rows sorted by unit: a spanning forest of the links within each unit."""

    def of_unit(prints: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = (prints[side == 0], prints[side == 1]) if side.any() and not side.all() else (prints, prints)
        near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
        a, b = np.nonzero(np.triu(near, 1) if left is right else near)
        kept = forest(left[a], right[b]) if len(a) else a
        return left[a[kept]], right[b[kept]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_units(batches, UNIT, ["fp", "side"]):
            prints, side, starts = rows["fp"].view(np.uint64), rows["side"], np.array(starts)
            sizes = np.diff(np.r_[starts, len(prints)])
            out = [(prints[starts[sizes == 2]], prints[starts[sizes == 2] + 1])]
            out[0] = tuple(x[np.bitwise_count(out[0][0] ^ out[0][1]) <= radius] for x in out[0])
            out += [of_unit(prints[s : s + n], side[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist()) if n > 2]
            a, b = (np.concatenate(x) for x in zip(*out))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, carry: str | None = None, similar: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, kept.

    Rows with one fingerprint are one class, represented by it, so copies are never paired. component_id is
    the smallest doc_id of all classes reachable by links, kept marks the row that has it. A null or empty
    text has fingerprint zero and links like any other; so does one of white space. Very long texts are
    read whole. Null doc_ids don't count for the smallest (a component of none but these has a null
    component_id and kept false). Rows that repeat a doc_id each give a row. Other columns are ignored; an
    empty table gives an empty one. With ``carry`` that string column is kept, and ``root`` tells components
    apart that have one component_id, as they may where an id is repeated with several texts.

    With ``similar`` (and ``carry``, which then has to tell texts apart) texts link as well whose different five-word
    shingles have at least that Jaccard similarity, whatever their fingerprints: found by bands of minima (0.991 of
    pairs at 0.8, more above), confirmed exactly.
    """
    if similar is not None and carry is None:
        raise ValueError("similar needs carry, a column that tells texts apart")
    prints = spooled(fingerprints(docs, width, carry, similar is not None), "simhash")
    classes = spooled(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    n, both = agreement(classes)
    parts = plan(n, both, radius)
    signed = classes.select("fp", F.explode(_signatures(parts)).alias("s")).select("fp", "s.probe", "s.key", F.xxhash64("fp").alias("spread"))
    units = in_units(signed, ["probe", "key"], "spread", CHUNK).select(*UNIT, "fp", "side")
    links = units.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_links(radius), "a long, b long")
    reached = connected_components(links)
    named = classes.join(reached, classes["fp"] == reached["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    if similar is not None:
        named = spooled(named, "roots")
        sketches = prints.join(named.select("fp", "root"), "fp")
        joined = connected_components(root_links(docs, sketches, carry, similar)).withColumnsRenamed({"node": "__node", "component": "__component"})
        named = named.join(joined, named["root"] == joined["__node"], "left").select("fp", "first_id", F.coalesce("__component", "root").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = named.join(least, "root").select("fp", "component_id", *([] if carry is None else ["root"]))
    return prints.join(members, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), *([] if carry is None else [carry, "root"])
    )
