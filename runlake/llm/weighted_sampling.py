"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document's terms are its lower-case words, their weights how often each is there. For each sample a term has, from hashes of
the term and the sample's number alone, two gamma variates r and c (each the sum of two exponential ones) and a uniform b. With
t = floor(ln(weight) / r + b) the term's rank is ln c - r * (t - b + 1); the term of least rank, with its t, is the
document's sample. (Samples of a group share r, each has a c and a b of its own: so each sample has the right law, for fewer logarithms.) Two documents have the same sample with a probability that is the generalised
Jaccard similarity of their weights: the sum of the lesser weights over the sum of the greater ones.

Documents are dealt out once, in buckets of neighbours by doc_id; each bucket also gets the first document of the
next one, so that a document's next stands in its bucket, and all that follows needs no more shuffling of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

#: Samples of a fingerprint, and bits of a sample as it is written.
SAMPLES, BITS = 64, 16
#: Samples whose ranks are computed in one row.
TOGETHER = 8
#: Documents of a bucket, at most so many buckets, ids whose ranks part the ids, parts of an id that many documents have.
BUCKET, BUCKETS, CELLS, PARTS = 512, 1 << 20, 256, 64
#: Bytes of text of a task.
TASK_BYTES = 32 << 20
WORD_GAP = r"[\x20\x09-\x0D]+"
LONGEST = (1 << 63) - 1
#: More than any rank.
BEYOND = 1 << 62


def _uniform(bits: Column, n: int) -> Column:
    return (bits + F.lit(0.5)) / F.lit(float(1 << n))


def gamma(u: Column, v: Column) -> Column:
    """A gamma variate of shape 2 from two uniform ones: the sum of two exponential variates."""
    return -F.ln(u * v)


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, term, log_weight, group) with a rank for each sample of the group, r0 and so on, and the sample's name in the rank's lowest bits.

    The least of a document's ranks is its sample. A rank is a fixed-point number, so that the last bit of a logarithm doesn't matter.
    What is needed twice is a column of its own, so that Spark computes it once.
    """
    each = range(TOGETHER)
    low = F.lit((1 << 20) - 1)
    rows = rows.withColumn("first", F.xxhash64("term", "group"))
    rows = rows.withColumn("r", gamma(_uniform(F.shiftrightunsigned("first", 32), 32), _uniform(F.col("first").bitwiseAND(F.lit((1 << 32) - 1)), 32)))
    rows = rows.withColumns({f"h{j}": F.xxhash64("first", F.lit(j)) for j in each})
    rows = rows.withColumns({f"b{j}": _uniform(F.col(f"h{j}").bitwiseAND(low), 20) for j in each})
    rows = rows.withColumns({f"t{j}": F.floor(F.col("log_weight") / F.col("r") + F.col(f"b{j}")) for j in each})

    def rank(j: int) -> Column:
        h, b, t = F.col(f"h{j}"), F.col(f"b{j}"), F.col(f"t{j}")
        c = gamma(_uniform(F.shiftrightunsigned(h, 40), 24), _uniform(F.shiftrightunsigned(h, 20).bitwiseAND(low), 20))
        at = F.floor((F.ln(c) - F.col("r") * (t - b + F.lit(1.0)) + F.lit(512.0)) * F.lit(float(1 << 36)))  # from -200 to 4, so 46 bits
        return F.shiftleft(at, BITS).bitwiseOR(h.bitwiseXOR(t * F.lit(40503)).bitwiseAND(F.lit((1 << BITS) - 1)))

    return rows.select(*keys, "group", "term", "skip_own", "skip_changed", *(rank(j).alias(f"r{j}") for j in each))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; texts without terms are like one another and unlike all others."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same / F.lit(float(SAMPLES)))


def written(samples: Column) -> Column:
    """Samples as hexadecimal digits, four for each; none for a text without terms."""
    return F.coalesce(F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), ""), F.lit(""))


def bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """(bucket, part, down, text): buckets follow the ids' order, parts that of an id that very many documents have.

    ``down`` falls as the id grows. Documents without an id are in a bucket of their own after all others, in parts by their texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # one row, of CELLS + 1 ids
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.percentile_approx("doc_id", [i / CELLS for i in range(CELLS + 1)], 10000).alias("ids")).first()
    ids, n = sorted(found["ids"] or []), found["n"]
    bounds = sorted(set(ids))
    each = max(1, min(BUCKETS // CELLS, -(-n // (CELLS * BUCKET))))
    parts = max(1, -(-(found["bytes"] or 0) // TASK_BYTES))
    many = sorted({a for a, b in zip(ids, ids[1:]) if a == b})
    listed = F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>")
    cell = F.size(F.filter(listed, lambda b: b <= F.col("doc_id")))
    low, high = (F.coalesce(F.try_element_at(listed, i), F.lit(bounds[-1] if bounds else 0)).cast("double") for i in (F.col("cell"), F.col("cell") + 1))
    within = F.floor((F.col("doc_id").cast("double") - low) / (high - low + 1.0) * F.lit(each))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("cell").cast("long") * each + F.least(F.greatest(within, F.lit(0)), F.lit(each - 1)))
    hot = F.col("doc_id").isNull() | F.col("doc_id").isin(many) if many else F.col("doc_id").isNull()
    part = F.when(hot, F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int")).otherwise(0)
    down = F.coalesce(F.bitwise_not("doc_id"), F.lit(LONGEST))
    return rows.withColumn("cell", F.when(F.col("doc_id").isNotNull(), cell)).select(bucket.cast("long").alias("bucket"), part.alias("part"), down.alias("down"), "text"), parts


PLACE = ["bucket", "part"]


def with_guests(rows: DataFrame) -> DataFrame:
    """The rows, and for each (bucket, part) a guest: the first row of the next one, after the last that of the first."""
    firsts = rows.groupBy(*PLACE).agg(F.min("down").alias("down"))  # a row for each bucket and part, without texts
    order = Window.orderBy(F.desc("bucket"), "part")
    last = F.last(F.struct(*PLACE)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sent = firsts.withColumn("to", F.coalesce(F.lag(F.struct(*PLACE)).over(order), last))
    # no more rows than BUCKETS and PARTS for each of CELLS ids, of four numbers each
    met = rows.join(F.broadcast(sent), [*PLACE, "down"]).groupBy("to", "down").agg(F.min("text").alias("text"))
    return rows.withColumn("guest", F.lit(0)).unionByName(met.select("to.*", "down", "text", F.lit(1).alias("guest")))


def edited(docs: DataFrame) -> DataFrame:
    """(bucket, part, pos, guest, down, n_chars, text, edited): each text, and that text with its last third replaced from the next.

    Rows of a bucket and part lie in one partition, and ``pos`` numbers them.
    """
    rows, parts = bucketed(docs)
    parts = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = Window.partitionBy(*PLACE).orderBy("guest", "down", "text")
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    placed = with_guests(rows).repartition(parts, *PLACE).withColumns({"pos": F.row_number().over(order), "next": F.lead("text").over(order)})
    return placed.select(*PLACE, "pos", "guest", "down", n.cast("long").alias("n_chars"), "text", F.when(F.col("guest") == 0, F.concat(F.left("text", n - third), F.left("next", third))).alias("edited"))


def samples_of(texts: DataFrame) -> DataFrame:
    """(bucket, part, pos, own, changed): the samples of each text and of its edited text, null for those without terms."""
    keys = [*PLACE, "pos"]
    both = F.array(F.struct(F.lit(1).alias("own"), F.col("text")), F.struct(F.lit(0).alias("own"), F.col("edited").alias("text")))
    each = texts.select(*keys, F.explode(both).alias("v")).select(*keys, "v.own", F.explode_outer(F.split(F.lower("v.text"), WORD_GAP)).alias("word"))
    counted = each.select(*keys, "own", F.when(F.col("word") != "", F.xxhash64("word")).alias("term")).groupBy(*keys, "term").agg(F.sum("own").alias("own"), F.sum(1 - F.col("own")).alias("changed"))
    # a weight that a term has in both texts has one rank, which counts for both
    a, b = F.col("own"), F.col("changed")
    one = lambda weight, mine, its: F.struct(weight.alias("weight"), F.lit(mine).alias("skip_own"), F.lit(its).alias("skip_changed"))
    weights = F.when(a == b, F.array(one(a, 0, 0))).when(b == 0, F.array(one(a, 0, BEYOND))).when(a == 0, F.array(one(b, BEYOND, 0))).otherwise(F.array(one(a, 0, BEYOND), one(b, BEYOND, 0)))
    weighted = counted.select(*keys, "term", F.explode(weights).alias("v")).select(*keys, "term", F.ln(F.col("v.weight").cast("double")).alias("log_weight"), "v.skip_own", "v.skip_changed")
    groups = F.explode(F.array(*(F.lit(g) for g in range(SAMPLES // TOGETHER)))).alias("group")
    ranks = ranked(weighted.select("*", groups), keys)
    each = [(side, skip, j) for side, skip in (("own", "skip_own"), ("changed", "skip_changed")) for j in range(TOGETHER)]
    least = ranks.groupBy(*keys, "group").agg(*(F.min(F.when(F.col("term").isNotNull(), F.col(f"r{j}") + F.col(skip))).alias(f"{side}{j}") for side, skip, j in each))

    def samples(side: str) -> Column:
        name = F.lit((1 << BITS) - 1)
        return F.when(F.col(f"{side}0") < BEYOND, F.array(*(F.col(f"{side}{j}").bitwiseAND(name).cast("int") for j in range(TOGETHER))))

    parts = least.groupBy(*keys).agg(*(F.array_sort(F.collect_list(F.when(samples(side).isNotNull(), F.struct("group", samples(side).alias("samples"))))).alias(side) for side in ("own", "changed")))
    return parts.select(*keys, *(F.when(F.size(side) > 0, F.flatten(F.col(f"{side}.samples"))).alias(side) for side in ("own", "changed")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint each whole text, and its edited text, which takes its last third from the next document by descending doc_id.

    Returns a row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The last document's next is the first; a table of one row has that row as its own next. A null text counts
    as an empty one; a text without words has the fingerprint '', is like another such text (1) and unlike all others
    (0). Documents without an id come after all others. Rows of one id are ordered by their text, or where very many
    have it by a hash of the text first; equal rows are neighbours. Other columns are ignored; an empty table gives an empty one.
    """
    texts = edited(docs)
    keys = [*PLACE, "pos"]
    next_ = F.lead("own").over(Window.partitionBy(*PLACE).orderBy("pos"))
    found = samples_of(texts).withColumn("next", next_)
    printed = found.select(*keys, written(F.col("own")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
    doc_id = F.when(F.col("bucket") >= 0, F.bitwise_not("down")).alias("doc_id")
    told = texts.filter("guest = 0").select(*keys, doc_id, "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return told.join(printed, keys).drop(*keys)
