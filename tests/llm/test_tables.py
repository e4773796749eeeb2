"""Operators over whole tables against brute force: mixing, near-duplicates, shards, WARC, components."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from runlake.llm import components, embedding_dedup, mixing, oracles, sharding, simhash, warc


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, 400 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots(501, links)
    assert got == {i: want[i] for a, b in links if a != b for i in (a, b)}


def test_no_links(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_units_hold_every_pair(spark):
    rows = spark.createDataFrame([(k, i, i * 7919) for k, n in ((1, 1), (2, 5), (3, 60)) for i in range(n)], "k int, i int, h long")
    got = components.in_units(rows, ["k"], "h", 8).collect()
    units = defaultdict(list)
    for r in got:
        units[r.k, r.low, r.high].append((r.k, r.i))
    pairs = {(k, a, b) for own in units.values() for k, a in own for _, b in own if a < b}
    assert pairs == {(k, a, b) for k, n in ((2, 5), (3, 60)) for a in range(n) for b in range(a + 1, n)}
    assert max(map(len, units.values())) < 40


def plain_fingerprint(text):
    lowered = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text)
    words = lowered.encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    source = [(r.doc_id, plain_fingerprint(r.text or "")) for r in odd.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((i, f"{f:016x}") for i, f in source)
    prints = sorted({f for _, f in source})
    root = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for i, f in source:
        if i is not None:
            k = root[prints.index(f)]
            least[k] = min(least.get(k, i), i)
    assert all(r.component_id == least.get(root[prints.index(int(r.fingerprint, 16))]) for r in rows)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("n", [200, 30_000, 10**9])
def test_every_plan_finds_all_links_within_the_radius(n):
    rng = np.random.default_rng(5)
    bits = rng.random((2000, 64)) < np.linspace(0.1, 0.9, 64)
    both = (bits.T.astype(float) @ bits) * (n / 2000)
    plan = simhash.plan(n, both, 3)
    assert sum(t + 1 for _, t in plan) == 4 and len({b for own, _ in plan for b in own}) == sum(len(own) for own, _ in plan)
    for _ in range(500):
        differ = set(rng.choice(64, rng.integers(0, 4), replace=False).tolist())
        assert any(len(differ & set(own)) <= t for own, t in plan)


def test_a_large_group_of_near_fingerprints(spark):
    rng = random.Random(4)
    prints = sorted({0x0123456789ABCDEF ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(1500)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fp long")
    signed = df.select("fp", F.explode(simhash._signatures([(list(range(16 * k, 16 * k + 16)), 0) for k in range(4)])).alias("s")).select("fp", "s.probe", "s.key", F.xxhash64("fp").alias("spread"))
    units = components.in_units(signed, ["probe", "key"], "spread", 64).select(*simhash.UNIT, "fp", "side")
    links = units.repartition(*simhash.UNIT).sortWithinPartitions(*simhash.UNIT).mapInArrow(simhash._links(3), "a long, b long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.distinct().collect()]
    at = {f: i for i, f in enumerate(prints)}
    want = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    assert roots(len(prints), [(at[a], at[b]) for a, b in got]) == want
    assert all((a ^ b).bit_count() <= 3 for a, b in got)


def test_mix_against_sql(odd, empty):
    documents = odd.select("doc_id", "source", "text").toArrow()
    got = mixing.mix(odd)
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({oracles.MIXING})").fetchall()
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want)
    assert mixing.mix(empty).count() == 0 and mixing.mix(empty, {"a": 1}).count() == 0
    mixed = mixing.in_mixed_order(odd)
    assert mixed.columns == odd.columns and Counter(mixed.collect()) == Counter(odd.collect())


def test_many_sources_against_sql(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('s', cast(sqrt(id * 30) as int)) AS source", "cast(null as string) AS text")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = mixing.mix(docs)
    columns = sorted(got.columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({oracles.MIXING})").fetchall())


def plain_schedule(weights, slots):
    """Earliest deadline first with fractions; ties go to the smaller weight, then to the source that is first."""
    from fractions import Fraction

    total, had, out = sum(weights.values()), Counter(), []
    for t in range(slots):
        due = [(math.ceil(Fraction(had[s] + 1) * total / w), w, s) for s, w in weights.items() if math.floor(Fraction(had[s]) * total / w) <= t]
        out.append(min(due)[2])
        had[out[-1]] += 1
    return out


@pytest.mark.parametrize(
    "weights",
    [
        {"a": 1, "b": 1, "c": 1},
        {"a": 1 / 3, "b": 1 / 3, "c": 1 / 3},
        {"a": 0.5, "b": 0.3, "c": 0.2, "gone": 0.4},
        {"a": math.sqrt(2), "b": math.sqrt(3), "c": math.sqrt(5)},
        {"a": 1e-6, "b": 1, "c": 1},
        {"a": 997, "b": 13, "c": 7},
    ],
)
def test_no_source_is_a_whole_block_off_its_exact_weight(spark, weights):
    docs = spark.createDataFrame([(i, "a" if i % 3 else "b" if i % 2 else "c") for i in range(6000)], "doc_id long, source string")
    every = mixing.mix(docs, weights, block=4)
    rows = every.filter("in_mix").select("slot", "source").distinct().orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows))) and len(rows) > (1 if weights["a"] == 997 else 20)
    total = sum(w for s, w in weights.items() if s != "gone")
    had = Counter()
    for t, r in enumerate(rows, 1):
        had[r.source] += 1
        assert all(abs(had[s] - w / total * t) < 1 for s, w in weights.items() if s != "gone")
    assert every.count() == 6000 and every.groupBy("slot", "place").count().filter("count > 1").count() == 0
    if max(weights.values()) <= 1000 and all(isinstance(w, int) for w in weights.values()):
        assert [r.source for r in rows] == plain_schedule(weights, len(rows))


def test_weights_are_read_exactly():
    assert mixing.exact({"a": 1 / 3, "b": 0.05, "c": 2}) == {"a": 20, "b": 3, "c": 120}
    assert mixing.exact({"a": 5000, "b": 3000, "c": 0}) == {"a": 5, "b": 3, "c": 0}
    irrational = mixing.exact({"a": math.sqrt(2), "b": math.pi, "c": math.e})
    assert abs(irrational["a"] / irrational["b"] - math.sqrt(2) / math.pi) < 1e-9
    with pytest.raises(ValueError):
        mixing.exact({"a": -1})


def test_sources_without_a_weight_come_after_the_mix(spark):
    docs = spark.createDataFrame([(i, "abcd"[i % 4]) for i in range(400)], "doc_id long, source string")
    rows = mixing.mix(docs, {"a": 2, "b": 1, "c": 0}, block=10).collect()
    last = max(r.slot for r in rows if r.source in "ab")
    assert sorted({(r.source, r.slot - last) for r in rows if r.source in "cd"}) == [("c", k) for k in range(1, 11)] + [("d", k) for k in range(11, 21)]
    assert not any(r.in_mix for r in rows if r.source in "cd") and any(r.in_mix for r in rows)
    for weights in ({}, {"a": 0}, {"elsewhere": 1}):
        rows = mixing.mix(docs, weights, block=10).collect()
        assert sorted({(r.slot, r.source) for r in rows}) == [(k, "abcd"[k // 10]) for k in range(40)] and not any(r.in_mix for r in rows)


def test_thousands_of_sources_take_seconds(spark):
    import time

    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id) AS source")
    began = time.time()
    rows = mixing.mix(docs).select("slot", "source").collect()
    assert len({r.slot for r in rows}) == 3000 and [r.source for r in sorted(rows)] == sorted(r.source for r in rows)
    assert time.time() - began < 20


def test_rows_without_an_id_spread_over_ranges(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) AS doc_id", "'one' AS source", "concat('text ', id) AS text")
    _, ranges = mixing.counted(docs, False)
    assert ranges.count() > 1500
    assert sorted((r.block, r.place) for r in mixing.mix(docs).collect()) == [(k // 64, k % 64) for k in range(4000)]


def test_a_schedule_too_long_for_one_task_is_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LONGEST", 50)
    docs = spark.range(12800).selectExpr("id AS doc_id", "concat('s', id % 2) AS source")
    with pytest.raises(ValueError, match="slots"):
        mixing.mix(docs, {"s0": 997, "s1": 991})
    monkeypatch.setattr(mixing, "BROADCAST", 1)  # the way without a broadcast
    assert mixing.mix(docs, {"s0": 2, "s1": 1}).select("slot", "place").distinct().count() == 12800


def vectors(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((60, 16))
    rows = [[float(x) for x in v] for v in base]
    rows += [[float(x) for x in base[k % 5] + rng.standard_normal(16) * s] for k in range(120) for s in (0.05, 0.2)]
    rows += [rows[3]] * 40 + [[2 * x for x in rows[3]]] * 2
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0, 0.0], [2.0, 4.0]]
    return [(i, v) for i, v in enumerate(rows)] + [(None, rows[4]), (7, rows[4]), (7, rows[8])]


def test_embeddings(spark, monkeypatch):
    rows = vectors(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cid": F.lit(1), "n": F.lit(2), "block": F.lit("x")})
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    cosine = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if fine[i] and fine[j] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.95]
    count = Counter(x for pair in linked for x in pair)
    root = roots(len(rows), linked)
    least = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            least[root[i]] = min(least.get(root[i], vec), vec)
    want = Counter((vec, count[i], least.get(root[i]) if fine[i] else vec) for i, (vec, _) in enumerate(rows))
    # small units, finer grids, other blocks and hashes that clash come to the same
    for chunk, axes, blocks, together in ((16384, (0, 1, 2, 3), (4, 8, 16), 256), (16, (0,), (4,), 5), (16, (3,), (4,), 16), (7, (2,), (8,), 16), (1000, (1,), (16,), 4)):
        monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
        monkeypatch.setattr(embedding_dedup, "GRID_AXES", axes)
        monkeypatch.setattr(embedding_dedup, "CELL", ["block", "dims", *(f"c{j}" for j in range(max(axes)))])
        monkeypatch.setattr(embedding_dedup, "UNIT", [*embedding_dedup.CELL, "low", "high"])
        monkeypatch.setattr(embedding_dedup, "BLOCKS", blocks)
        monkeypatch.setattr(embedding_dedup, "TOGETHER", together)
        if chunk == 7:
            monkeypatch.setattr(embedding_dedup, "_vector_hash", lambda: F.when(F.col("embedding").isNotNull(), F.pmod(F.xxhash64("embedding"), F.lit(2))))
        got = embedding_dedup.near_duplicates(df).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(df.filter("vec_id is null or size(embedding) = 0")).count() == 2
    embeddings = df.select("vec_id", "embedding").toArrow()  # noqa: F841 - the table that the SQL names
    sql = duckdb.sql(oracles.EMBEDDINGS).fetchall()
    assert Counter(sql) == Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)


def page_rows():
    long = "".join(f"<p>é{i}\r\n\r\nWARC/1.1</p>" for i in range(4000))
    return [(5, "http://a", "<b>x</b>"), (3, None, "<b>x</b>"), (9, "u\r\nv", "<b>x</b>"), (1, "u", None), (2, "u", ""), (4, "u", long), (6, "u", long), (None, "u", "<b>x</b>"), (None, "u", "only"), (None, "u", "only"), (8, "u", "tail\r\n\r\n"), (11, "u", "0\r\n\r\n"), (12, "u", "twice"), (12, "u", "twice"), (12, "v", "twice"), (13, "u", "twice"), (14, "u", long), (1, "u", "")]


def test_warc(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha1": F.lit("x"), "first": F.lit(1), "record_type": F.lit("y")})
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    answered = set()
    for i, _, html in rows:
        data = (html or "").encode()
        least = first.get(html or "")
        back = None if least is None or (i == least and (html or "") not in answered) else least
        if i == least:
            answered.add(html or "")
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if back is None else "revisit", back)] += 1
    got = warc.round_trip(df)
    assert Counter(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())) == want
    assert warc.round_trip(df.limit(0)).count() == 0
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url", "html").toArrow())
    assert Counter(con.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({oracles.WARC})").fetchall()) == want


def test_segments_are_verified():
    parts = [(2, None, b"bc"), (1, None, b"a"), (3, 4, b"d")]
    assert warc.whole(parts) == b"abcd"
    for wrong in (parts[:2], parts[1:], [(1, 9, b"a")], [(1, None, b"a"), (1, None, b"a")]):
        with pytest.raises(ValueError):
            warc.whole(wrong)
    for body in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(body)
    assert warc.unchunked(warc.chunked("é日".encode() * 3000)) == "é日".encode() * 3000


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    import gzip

    data = warc.records_of(1, "u", b"abc", warc.base32_sha1(b"abc"), None, "0")[0].replace(b"abc", b"abd") + warc.END
    (tmp_path / "a.gz").write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="stated digest"):
        warc.read(spark, str(tmp_path)).collect()


def test_archives_are_read_in_bounded_memory():
    """200 MB of records, gzipped as a whole or one by one, take a few megabytes; a file that is cut off is an error."""
    import gzip
    import tracemalloc

    record = warc.record("response", {"WARC-Record-ID": "<urn:x-page:1:X>"}, bytes(range(256)) * 64) + warc.END
    once = gzip.compress(record * 500)
    for data, n in ((once * 24, 12_000), (gzip.compress(record) * 100, 100), (gzip.compress(b""), 0)):
        tracemalloc.start()
        assert sum(len(block) == 16384 for _, block in warc.parse(warc.inflated(data))) == n
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
        tracemalloc.stop()
    assert list(warc.parse(record * 3)) == list(warc.parse(iter([record[:9], record[9:] + record[:1], record[1:] + record]))) and len(list(warc.parse(record))) == 1
    for wrong in (once[:-9], gzip.compress(record[:-5]), gzip.compress(b"WARC/1.1" + b"x" * (2 << 20))):
        with pytest.raises((EOFError, ValueError)):
            list(warc.parse(warc.inflated(wrong)))


def test_large_pages(spark, tmp_path, monkeypatch):
    """Pages of megabytes: files hold a bounded number of records, and the pages come back whole."""
    monkeypatch.setattr(warc, "FILE_RECORDS", 300)
    pages = spark.createDataFrame([(k, f"u{k}", f"page {k} " * 400_000) for k in range(4)] + [(9, "u9", "page 1 " * 400_000)], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    files = list((tmp_path / "w").glob("*.gz"))
    assert len(files) >= 4 * 2_800_000 / (300 * warc.SEGMENT)
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert got == {k: (2_800_000, "response", None) for k in range(4)} | {9: (2_800_000, "revisit", 1)}


def test_very_large_and_very_small_vectors(spark):
    """Squares of such numbers vanish or overflow; their cosines are as those of others."""
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2.1e200]), (3, [1e-200, 1e-200]), (4, [-1e-200, 3e-200]), (5, [1.0, 1.0]), (6, [5e-324, 0.0]), (7, [3.0, 0.0]), (8, [1e308, -1e308]), (9, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (0, 4), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9)}
    x = np.array([[0.1, 0.7, -0.3], [3.0, 1e-3, 0.0], [0.0, 0.0, 0.0]])
    assert np.array_equal(embedding_dedup.balanced(x), x * [[1.0], [0.25], [1.0]])  # powers of two, so nothing is rounded


def test_equal_sources_of_any_size_have_a_short_period(spark):
    """The weights' common divisor goes: a hundred sources of 120 million rows each take a period of a hundred slots."""
    ranges = spark.range(100).selectExpr("cast(id AS string) AS source", "0 AS range", "120000000L AS n")
    shares = mixing.weighed(ranges, None, mixing.BLOCK)
    _, period, slots = mixing.schedule(shares)
    assert (period, slots) == (100, 100) and {r.w for r in shares.collect()} == {1}
    uneven = spark.createDataFrame([("a", 0, 36 * 49), ("b", 0, 36 * 100), ("c", 0, 36 * 225)], "source string, range int, n long")
    assert sorted(r.w for r in mixing.weighed(uneven, None, mixing.BLOCK).collect()) == [7, 10, 15]
    assert mixing.weighed(uneven.limit(0), None, mixing.BLOCK).count() == 0


def test_shards(spark, odd, empty):
    rows = sharding.shard_documents(odd, target=1 << 20).collect()
    digest = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((r.doc_id, digest(r.text)) for r in odd.select("doc_id", "text").collect())
    per = Counter(r.shard for r in rows)
    assert all(per[r.shard] == r.shard_rows for r in rows)
    assert sharding.shard_documents(empty).count() == 0


def test_the_same_table_gives_the_same_shards(spark, odd):
    first, second = (Counter((r.doc_id, r.text_sha256, r.shard) for r in sharding.shard_documents(odd.repartition(6, "doc_id"), target=200_000).collect()) for _ in range(2))
    assert first == second and len({s for _, _, s in first}) > 1


def test_compaction_and_versions(spark, tmp_path):
    store = sharding.Shards(spark, f"file://{tmp_path}", target=1 << 20)
    assert store.version() == 0 and store.read() is None
    for k in range(5):
        store.append(spark.range(k * 100, k * 100 + 100, 1, 2))
    before = store.shards()
    assert store.version() == 5 and len(before) == 10
    version = store.compact()
    assert version > 5 and len(store.shards()) < sharding.FANOUT
    assert sorted(r.id for r in store.read().collect()) == list(range(500))
    assert store.compact() == version  # nothing is left to merge
    assert sorted(r.id for r in store.read(5).collect()) == list(range(500))  # merged shards stay for its readers
    assert store.vacuum(keep=version - 4) == 0 and store.shards(5) == before
    assert store.vacuum() == 10 and store.vacuum() == 0
    assert len(list(tmp_path.glob("data/*/*.parquet"))) == len(store.shards()) and len(list(tmp_path.glob("manifest/[0-9]*.json"))) == 1
    assert len(list(tmp_path.glob("segments/*.jsonl"))) == len(store.segments(version))
    assert sorted(r.id for r in store.read().collect()) == list(range(500))


def test_a_second_writer_tries_again(spark, tmp_path, monkeypatch):
    first, second = (sharding.Shards(spark, f"file://{tmp_path}") for _ in range(2))
    first.append(spark.range(0, 10, 1, 1))
    with pytest.raises(sharding.Conflict):
        first._publish(0, [])
    with monkeypatch.context() as m:
        m.setattr(sharding, "RENAMING", ())  # as on an object store
        with pytest.raises(sharding.Conflict):
            first._publish(0, [])
    stale = iter([1, 1])  # what it sees before the other one's append
    first.append(spark.range(10, 20, 1, 1))
    monkeypatch.setattr(second, "version", lambda: next(stale, None) or sharding.Shards.version(second))
    assert second.append(spark.range(20, 30, 1, 1)) == 3
    assert sorted(r.id for r in first.read().collect()) == list(range(30))
    own = first.shards()
    merged = first._written(first.read().drop("shard").coalesce(1))
    assert first._change(own[:2], merged) == 4
    assert first._change(own, merged) is None and first.version() == 4  # one of them has gone by now


def test_tiers(spark, tmp_path, monkeypatch):
    """Merges by plain lists of sizes; segments are cut small, so shards of a tier stand in many."""
    monkeypatch.setattr(sharding, "SEGMENT_SHARDS", 3)
    store, rng = sharding.Shards(spark, f"file://{tmp_path}", target=10_000), random.Random(5)
    sizes: list[int] = []
    for k in range(30):
        sizes.append(rng.choice([10, 60, 300, 900, 3000, 4900, 5001, 9000]))
        store._change([], [{"path": f"/{k:04d}", "bytes": sizes[-1]}])
        plain: dict[int, list[str]] = defaultdict(list)
        for path, n in sorted((s["path"], s["bytes"]) for s in store.shards()):
            if n <= 5000:
                plain[next(t for t in range(20) if n < 4 ** (t + 1))].append(path)
        want = next((own for _, own in sorted(plain.items()) if len(own) >= 4), [])
        due = store.due(store.segments(store.version()))
        assert [s["path"] for s in due] == want
        if due:
            new = {"path": f"/{k:04d}m", "bytes": sum(s["bytes"] for s in due)}
            sizes = [n for n in sizes]
            store._change(due, [new])
            assert {s["path"] for s in store.shards()}.isdisjoint(s["path"] for s in due)
    assert sum(s["bytes"] for s in store.shards()) == sum(sizes) and all(s["n"] <= 3 for s in store.segments(store.version()))
