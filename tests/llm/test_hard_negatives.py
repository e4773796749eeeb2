"""Hard negatives, against all pairs of vectors."""

import math
import random

import numpy as np
import pytest

from runlake.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """The contract's rows by comparing each anchor with every row, in whole numbers of any size."""
    usable = []
    for id_, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((id_, [math.floor(256 * x) for x in v], (label + 1) % 10 if id_ is not None and id_ % 7 == 0 else label))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (id_, v, label) in enumerate(usable):
        if id_ is None or id_ % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), other, own == label) for b, (other, w, own) in enumerate(usable) if b != a]
        for score, positive, _ in sorted((s for s in scored if s[2]), key=key)[:5]:
            fit = sorted((s for s in scored if not s[2] and 30 * score <= 100 * s[0] <= 90 * score), key=key)[:10]
            out += [(id_, positive, rank, negative, score, s) for rank, (s, negative, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(n, dim, seed, labels=4, centres=6, step=1):
    """Clustered vectors; every tenth copies another, and some differ by very little."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    out = []
    for k in range(n):
        v = middle[k % centres] + rng.normal(size=dim) * 0.4
        v = list(out[int(rng.integers(len(out)))][1]) if out and k % 10 == 3 else (v / np.linalg.norm(v) * rng.uniform(0.4, 1)).tolist()
        out.append((k * step, v, int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("dim, seed", [(1, 1), (2, 2), (8, 3), (24, 4)])
def test_all_pairs(spark, monkeypatch, dim, seed):
    rows = some(600, dim, seed, step=5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    assert want and got(H.hard_negatives(df)) == want
    for name, value in (("LEAF", 16), ("SAMPLE", 90), ("LEAST_OF_SAMPLE", 4), ("FANOUT", 3), ("SIDE_BYTES", 8 * dim * 20), ("ANCHORS", 7), ("TILE", 4)):
        monkeypatch.setattr(H, name, value)
    assert got(H.hard_negatives(df.repartition(5))) == want  # a deep tree, leaves of many chunks, anchors in many deals


def test_the_tree_rules_leaves_out(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(20, 3)) * 200
    x = np.floor(np.concatenate([m + rng.normal(size=(100, 3)) * 4 for m in middle]))
    tree = H.grown(x[rng.permutation(len(x))], len(x), float(np.sqrt((x**2).sum(1).max())), "<i4")
    assert tree.leaves >= 8 and len(set(tree.leaf_of(x).tolist())) == tree.leaves
    tree.least, tree.most = ([np.full((len(c),) * 2, f) for c in tree.children] for f in (np.inf, -np.inf))
    for node, _, away, nearest in tree.paths(x):
        for p in range(len(tree.children[node])):
            if (nearest == p).any():
                tree.least[node][:, p], tree.most[node][:, p] = away[nearest == p].min(0), away[nearest == p].max(0)
    scores = x[:50] @ x.T
    top = np.sort(scores, 1)[:, -10:][:, 0]
    for lows, highs in ((top, np.full(50, 2.0**62)), (0.4 * top, 0.5 * top), (top + 1, top)):
        anchor, leaf = tree.reached(x[:50], lows[:, None], highs[:, None])
        pairs = set(zip(anchor.tolist(), leaf.tolist()))
        must = {(int(a), int(tree.leaf_of(x)[b])) for a, b in np.argwhere((scores >= lows[:, None]) & (scores <= highs[:, None]))}
        assert must <= pairs and len(pairs) < 0.8 * 50 * tree.leaves


def test_odd_rows(spark):
    rng = random.Random(6)
    v = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    base = v()
    rows = [(k, v(), k % 3) for k in range(0, 400, 4)] + [(500, base, 1), (500, base, 1), (501, base, 1), (503, base, 2), (503, base, 2), (502, [x * 0.6 for x in base], 2)]
    rows += [(None, base, 1), (None, [x * 0.7 for x in base], 2), (600, None, 1), (700, base, None), (800, [1.0, None, 0.0, 0.0], 1), (900, [math.nan] * 4, 1), (1000, [math.inf, 0.0, 0.0, 0.0], 1), (1100, [0.0] * 4, 1), (1200, base[:2], 1), (1300, [], 2), (-100, base, 0)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in ("row", "id", "leaf", "score", "rank", "vec")})
    assert got(H.hard_negatives(df)) == brute(rows)
    assert got(H.hard_negatives(df.limit(0))) == []
    assert got(H.hard_negatives(df.filter("vec_id = 1100"))) == []
    assert [c for c, _ in H.hard_negatives(df.limit(0)).dtypes] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_equal_vectors_and_large_numbers(spark):
    copies = [(k, [0.5, 0.5], k % 2) for k in range(0, 3000, 10)]
    assert got(H.hard_negatives(spark.createDataFrame(copies, SCHEMA))) == brute(copies) == []
    scaled = [(k, [0.5, 0.5] if k % 2 else [0.3, 0.3 + k % 5 / 100], k % 2) for k in range(0, 3000)]
    scaled = [r for r in scaled if r[0] % 3 == 0]
    assert got(H.hard_negatives(spark.createDataFrame(scaled, SCHEMA))) == brute(scaled)
    for scale in (300.0, 400_000.0):  # beyond what single and double precision hold exactly
        large = [(k, [scale * x for x in v], label) for k, v, label in some(200, 3, 7, step=10)]
        assert got(H.hard_negatives(spark.createDataFrame(large, SCHEMA))) == brute(large)
    with pytest.raises(ValueError, match="64 bits"):
        H.hard_negatives(spark.createDataFrame([(100, [1e200], 1)], SCHEMA))
