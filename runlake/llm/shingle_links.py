"""Links between texts that share enough of their word shingles, beside those of fingerprints.

No radius of a 64-bit fingerprint that can be searched at scale has most pairs of similarity 0.8. Candidates come from
banded minima instead: texts of similarity s meet in a band with a chance of s ** ROWS, so 0.8 in one of the BANDS with
0.991. What meets is compared exactly, set by set, and only where fingerprints haven't joined it already.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smaller_batches, spooled, text_or_empty
from .components import forest, whole_units

WIDTH, BANDS, ROWS = 5, 12, 5
#: A chunk of a bucket has about so many texts and so many shingles at most; a unit compares two chunks.
CHUNK, CHUNK_SHINGLES = 128, 1 << 20
UNIT = ["band", "bucket", "low", "high"]

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.random.default_rng(42).integers(1, 1 << 63, size=(2, BANDS * ROWS, 1), dtype=np.uint64)
_TIMES, _PLUS = _MIX[0] * np.uint64(2) + np.uint64(1), _MIX[1]


def shingles(text: str) -> np.ndarray:
    """The different runs of WIDTH lower-case words, hashed, ascending; of fewer words their whole sequence, of none nothing."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(WIDTH)))) if len(words) >= WIDTH else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(7)), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """For each band a hash of its ROWS minima; none for a text without words."""
    if not len(hashes):
        return []
    least = np.full((BANDS * ROWS, 1), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[None, at : at + 4096] * _TIMES + _PLUS).min(axis=1, keepdims=True))
    return [xxhash.xxh64_intdigest(row.tobytes()) - (1 << 63) for row in least.reshape(BANDS, ROWS)]


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets share."""
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = n > 1  # the others are shared by none
    at, place = at[several[place]], (np.cumsum(several) - 1)[place[several[place]]]
    order = np.argsort(place, kind="stable")
    at, place = at[order], place[order]
    out = np.zeros((len(sets), len(sets)))
    for first in range(0, int(several.sum()), 4096):
        own = slice(*np.searchsorted(place, (first, first + 4096)))
        has = np.zeros((len(sets), 4096), dtype=np.float32)
        has[at[own], place[own] - first] = 1
        out += has @ has.T
    return out


def similar_pairs(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit, of two roots and of two sides where it has two, whose sets have a Jaccard similarity of ``least`` or more."""
    size = np.array([len(s) for s in sets], dtype=np.float64)
    wanted = np.triu(root[:, None] != root[None, :], 1) & (np.minimum.outer(size, size) >= least * np.maximum.outer(size, size) - 1)
    if side.any() and not side.all():
        wanted &= side[:, None] != side[None, :]
    a, b = np.nonzero(wanted)
    if len(a) <= 2 * len(sets):
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())], dtype=np.float64)
    else:
        both = _shared(sets)[a, b]
    near = both / (size[a] + size[b] - both) >= least if len(a) else np.zeros(0, dtype=bool)
    return a[near], b[near]


def _verified(least: float):
    """For ``mapInArrow`` over rows sorted by unit: a spanning forest of the roots that similar texts link within each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smaller = (piece for batch in batches for piece in smaller_batches(batch, "hashes", 16 << 20))
        for rows, starts in whole_units(smaller, UNIT, ["side", "root", "hashes"]):
            left, right = [], []
            for start, end in zip(starts, [*starts[1:], len(rows["root"])]):
                root = rows["root"][start:end]
                sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["hashes"][start:end]]
                a, b = similar_pairs(sets, root, rows["side"][start:end], least)
                if len(a):
                    kept = forest(root[a], root[b])
                    left.append(root[a[kept]])
                    right.append(root[b[kept]])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (left, right)], names=["a", "b"])

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in smaller_batches(whole, "text", 8 << 20)):
        sets = pa.array((shingles(t.as_py()).tobytes() for t in batch["text"]), pa.binary())
        yield pa.RecordBatch.from_arrays([batch["key"], sets], names=["key", "hashes"])


def root_links(docs: DataFrame, sketches: DataFrame, key: str, least: float) -> DataFrame:
    """Pairs (a, b) of roots that texts with a shingle similarity of ``least`` or more link.

    ``docs`` has the texts and in ``key`` a string that tells them apart; ``sketches`` has a row or more for each key:
    its doc_id, root, band_keys and n_shingles. Each text counts once. Buckets whose texts have one root hold nothing to find,
    of buckets with the same texts one is read; larger ones are cut into units of bounded size, none is dropped.
    """
    once = sketches.filter("n_shingles > 0").groupBy(F.col(key).alias("key")).agg(F.first("root").alias("root"), F.first("n_shingles").alias("n"), F.first("band_keys").alias("keys"), F.min(F.coalesce("doc_id", F.lit(0))).alias("first"))
    dealt = spooled(once.select("key", "root", "n", "first", F.posexplode("keys").alias("band", "bucket")), "bands")
    buckets = dealt.groupBy("band", "bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("all"), F.bit_xor(F.xxhash64("key")).alias("those"))
    one = buckets.filter("lo <> hi").groupBy("lo", "hi", "texts", "all", "those").agg(F.min(F.struct("band", "bucket")).alias("at"))
    chunks = F.greatest(F.ceil(F.col("texts") / CHUNK), F.ceil(F.col("all") / CHUNK_SHINGLES)).cast("int")
    read = dealt.join(one.select("at.*", chunks.alias("chunks")), ["band", "bucket"])
    own, other = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    units = spooled(
        read.withColumn("own", own).withColumn("other", other).select("band", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side"), "key", "root", "first"), "units"
    )
    # of copies the row of the smallest id is read, so that a text with very many is no task's burden
    named = docs.select(F.col(key).alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("first"), text_or_empty().alias("text"))
    texts = named.join(units.select("key", "first").distinct(), ["key", "first"], "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    full = units.join(texts.mapInArrow(_hashes, "key string, hashes binary"), "key").select(*UNIT, "side", "root", "hashes")
    return full.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_verified(least), "a long, b long")
