"""Fingerprints by consistent weighted sampling, against a plain re-implementation and the exact similarity."""

import hashlib
import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from runlake.llm import weighted_sampling as W

MASK = (1 << 64) - 1


def hash_long(x, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<q", x), seed)


def hash_int(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", x), seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def uniform(bits, n):
    return (bits + 0.5) / float(1 << n)


def weights(text):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w)


def plain(text):
    """The samples of a text, term by term."""
    terms = {xxhash.xxh64_intdigest(w.encode(), 42): n for w, n in weights(text).items()}
    out = []
    for k in range(W.SAMPLES if terms else 0):
        group, j = divmod(k, W.TOGETHER)
        best = None
        for term, n in terms.items():
            first = hash_int(group, hash_long(signed(term)))
            r = -math.log(uniform(first >> 32, 32) * uniform(first & 0xFFFFFFFF, 32))
            h = hash_int(j, hash_long(signed(first)))
            b = uniform(h & 0xFFFFF, 20)
            t = math.floor(math.log(n) / r + b)
            c = -math.log(uniform(h >> 40, 24) * uniform(h >> 20 & 0xFFFFF, 20))
            at = math.log(c) - r * (t - b + 1.0)
            best = min(best or (math.inf,), (at, (h ^ (t * 40503 & MASK)) & 0xFFFF))
        out.append(best[1])
    return out


def edited_texts(rows):
    """(doc_id, text, edited text, next text) of rows in descending order of ids, those without one last."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(t) // 3
        yield i, t, t[: len(t) - third] + after[:third], after


def alike(a, b):
    return 1.0 if not a and not b else 0.0 if not a or not b else sum(x == y for x, y in zip(a, b)) / W.SAMPLES


def want(rows):
    out = []
    for i, t, changed, after in edited_texts(rows):
        own, other, next_ = plain(t), plain(changed), plain(after)
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), *("".join(f"{x:04x}" for x in s) for s in (own, other)), alike(own, other), alike(own, next_)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


TEXTS = ["a b c a a b", "", None, "one", "The the THE quick", " \t\n", "naïve café — 日本語 \U0001f600 tail", "x" * 50, "to be or not to be that is the question " * 9, "a b c a a b"]


def test_plain_samples(spark, monkeypatch):
    rows = [(k * 3, TEXTS[k % len(TEXTS)]) for k in range(23)] + [(None, "no id"), (None, None), (6, "twice the id"), (6, "twice the id"), (-5, "below zero"), (2**63 - 1, "high"), (-(2**63), "low")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bucket string")
    expected = want(rows)
    # rows without an id are in the order of their texts within a part; here they are in one
    monkeypatch.setattr(W, "PARTS", 1)
    assert got(W.fingerprints(df.repartition(3))) == expected
    monkeypatch.setattr(W, "BUCKET", 1)  # every document in a bucket of its own, or nearly
    monkeypatch.setattr(W, "CELLS", 4)
    monkeypatch.setattr(W, "TASK_BYTES", 50)
    assert got(W.fingerprints(df.coalesce(1))) == expected


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_documents(spark, n):
    rows = [(7, "a b c"), (3, "d e f g h i")][:n]
    assert got(W.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == want(rows)


def test_odd_tables(spark, odd, empty):
    assert W.fingerprints(empty).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    out = W.fingerprints(odd).toPandas()
    assert len(out) == len(rows) and out.near_edited.between(0, 1).all() and out.near_next.between(0, 1).all()
    named = out[out.doc_id.notna()]
    by_id = {i: hashlib.sha256(c.encode()).hexdigest() for i, _, c, _ in edited_texts(rows) if i is not None and i > 5}
    assert all(by_id[int(r.doc_id)] == r.edited_sha256 for r in named.itertuples() if r.doc_id > 5 and r.doc_id > named.doc_id.min())
    twins = named[named.doc_id == 5]
    assert twins.fingerprint.iloc[0] == twins.fingerprint.iloc[1]
    assert all((r.fingerprint == "") == (not weights(t or "")) for r in named.itertuples() for t in [dict(x for x in rows if x[0] is not None)[int(r.doc_id)]])


def test_an_id_of_very_many_documents(spark):
    rows = [(9, f"text {k} of one id") for k in range(400)] + [(k, f"own text {k}") for k in range(200) if k != 9]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts, parts = W.bucketed(df)
    spread = texts.filter(F.col("down") == ~9).groupBy("part").count().collect()
    assert len(spread) > W.PARTS // 2  # one id, many tasks
    out = W.fingerprints(df).select("doc_id", "edited_sha256").collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    heads = {t[: len("own text 10") // 3] for i, t in rows if i == 9}
    ten = next(r.edited_sha256 for r in out if r.doc_id == 10)  # its next is one of the many
    assert ten in {hashlib.sha256(("own text 10"[:8] + h).encode()).hexdigest() for h in heads}


def test_likeness_is_the_generalised_jaccard_similarity(spark):
    rows = []
    for k in range(300):  # some neighbours share words, with weights from 1 to 30; others have words of their own
        rows.append((k, " ".join(f"w{j}of{k // 4}" for j in range(60) for _ in range((j * j + k * (j % 7)) % 31 if (j + k // 3) % 4 else 0))))
    out = W.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    gaps = []
    for i, t, changed, after in edited_texts(rows):
        a = weights(t)
        for other, near in ((changed, out.near_edited[i]), (after, out.near_next[i])):
            b = weights(other)
            keys = a.keys() | b.keys()
            gaps.append(near - sum(min(a[x], b[x]) for x in keys) / sum(max(a[x], b[x]) for x in keys))
    assert abs(sum(gaps) / len(gaps)) < 0.02 and (sum(g * g for g in gaps) / len(gaps)) ** 0.5 < 0.1


def test_documents_run_without_python(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    plan = W.fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
