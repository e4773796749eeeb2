"""Links by shared shingles against brute force and against all similar pairs of a table."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from runlake.llm import shingle_links, simhash

from .conftest import prose
from .test_tables import plain_fingerprint, roots


def plain_runs(text):
    """Five-word runs of the words as operator 5 has them."""
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One two", "a b c d e", "a b c d e f", "A b c d e a b c d e a", "naïve café — 日本語 ok É", prose(1, 5000)])
def test_shingles(text):
    found = shingle_links.shingles(text)
    assert len(found) == len(plain_runs(text)) and (np.diff(found.astype(object)) > 0).all()
    keys = shingle_links.band_keys(found)
    assert len(keys) == (shingle_links.BANDS if plain_runs(text) else 0)
    assert keys == shingle_links.band_keys(shingle_links.shingles(text.upper() if text.isascii() else text))


def test_similar_pairs():
    rng = random.Random(4)
    for n in (2, 3, 9, 40):
        sets = [np.array(sorted(rng.sample(range(30), rng.randint(18, 30))), dtype=np.uint64) for _ in range(n)]
        for sides in (False, True):
            root, side = np.array([rng.randrange(1 + n // 2) for _ in range(n)]), np.array([rng.randrange(2) * sides for _ in range(n)])
            a, b = shingle_links.similar_pairs(sets, root, side, 0.8)
            two = sides and 0 < side.sum() < n
            want = set()
            for i, j in combinations(range(n), 2):
                x, y = set(sets[i].tolist()), set(sets[j].tolist())
                if root[i] != root[j] and (not two or side[i] != side[j]) and 10 * len(x & y) >= 8 * len(x | y):
                    want.add((i, j))
            assert set(zip(a.tolist(), b.tolist())) == want


def test_more_values_than_one_block():
    rng = random.Random(6)
    sets = [np.array(sorted(rng.sample(range(9000), 6000)), dtype=np.uint64) for _ in range(12)]
    got = shingle_links._shared(sets)
    assert all(got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in combinations(range(12), 2))


def test_a_bucket_of_many_texts_is_cut_into_units(spark, monkeypatch):
    """Every pair of a large group is looked at, whatever the size of a chunk; other columns and nulls do no harm."""
    monkeypatch.setattr(shingle_links, "CHUNK", 7)
    monkeypatch.setattr(shingle_links, "CHUNK_SHINGLES", 2000)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(60):  # a chain: each is similar to a few before it
        base[(3 * k) % 200] = f"new{k}"
        rows.append((k, " ".join(base)))
    rows += [(200 + k, t) for k, t in enumerate([None, "", "one two", "One  two", "lone words here", rows[0][1], rows[0][1].upper()])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.sha2(F.coalesce("text", F.lit("")), 256), "root": F.lit("x"), "band": F.lit(1), "n": F.lit(2)})
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 0, carry="key", similar=0.8).collect()}
    texts = [t or "" for _, t in rows]
    prints, runs = [plain_fingerprint(t) for t in texts], [plain_runs(t) for t in texts]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if prints[i] == prints[j] or (runs[i] and runs[j] and 10 * len(runs[i] & runs[j]) >= 8 * len(runs[i] | runs[j]))]
    root = roots(len(rows), near)
    least = {}
    for (i, _), k in zip(rows, root, strict=True):
        least[k] = min(least.get(k, i), i)
    assert got == {i: least[k] for (i, _), k in zip(rows, root, strict=True)}


def all_similar(texts, least=0.8):
    """Every pair of similarity ``least`` or more: pairs that share one of their rarest runs, then exactly."""
    runs = [plain_runs(t) for t in texts]
    n = Counter(x for r in runs for x in r)
    holds = defaultdict(list)
    for i, r in enumerate(runs):
        ranked = sorted(r, key=lambda x: (n[x], x))
        for x in ranked[: len(r) - ceil(least * len(r) - 1e-9) + 1]:
            holds[x].append(i)
    pairs = {p for own in holds.values() for p in combinations(own, 2)}
    return [(i, j) for i, j in pairs if 10 * len(runs[i] & runs[j]) >= round(10 * least) * len(runs[i] | runs[j])]


def test_recall_of_similar_pairs(spark):
    """Of all pairs of different texts of sf0.1 at 0.8 or more at least 0.95 are in one group; 24 of 48 are within 6 bits."""
    path = "/root/testdata/sf0.1/documents.parquet"
    texts = sorted({t for t in pq.read_table(path, columns=["text"])["text"].to_pylist() if t})
    pairs = all_similar(texts)
    docs = spark.read.parquet(path).withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = simhash.near_duplicates(docs, 3, carry="key", similar=0.8).join(docs.select("doc_id", "text"), "doc_id")
    group = {r.text: r.component_id for r in found.select("text", "component_id").collect()}
    assert len(pairs) >= 40
    assert sum(group[texts[i]] == group[texts[j]] for i, j in pairs) >= 0.95 * len(pairs)
