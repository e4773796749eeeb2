"""Mixing sources to target weights by a Pfair schedule.

Each source's rows are cut into blocks. Weights are whole numbers; their sum is the period. With weight w of a
period D, a source's i-th block (from 0) is released at slot floor(i D / w) and due by slot ceil((i + 1) D / w).
Each slot goes to the released block that is due first, so no source is ever a whole block ahead of or
behind its exact weight. The schedule repeats after D slots: one period, or as much of it as comes before the
first source has run out, is computed over sources and slots alone, and every block finds its slot by its
number in its source. Once a source has run out there is no mix to keep to: what is left goes by its deadlines.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spooled

#: Rows of a block; slots of a schedule at most, and of one that is broadcast (some 100 bytes each).
BLOCK, LONGEST, BROADCAST = 64, 1 << 20, 1 << 16
#: Weights that aren't fractions of small numbers are shares of so much.
FINEST = 1 << 31

Weights = dict[str, int | float | Fraction]


def exact(weights: Weights) -> dict[str, int]:
    """Whole numbers in the same ratios. A float is read as the simplest fraction that it stands for (1/3, 0.05).

    Where such fractions have no common denominator of a reasonable size, shares are rounded to 2**-31.
    """
    if any(w < 0 or not math.isfinite(w) for w in weights.values()):
        raise ValueError("weights are finite numbers from zero")
    found = {}
    for source, w in weights.items():
        tries = (Fraction(w).limit_denominator(10**k) for k in range(1, 16))
        found[source] = next((f for f in tries if float(f) == float(w)), Fraction(w))
    common = math.lcm(*(f.denominator for f in found.values())) if found else 1
    whole = {source: int(f * common) for source, f in found.items()}
    total = sum(whole.values())
    if total > FINEST:
        whole = {source: max(int(n > 0), round(Fraction(n * FINEST, total))) for source, n in whole.items()}
    divisor = math.gcd(*whole.values()) or 1
    return {source: n // divisor for source, n in whole.items()}


def counted(docs: DataFrame, carry: bool) -> tuple[DataFrame, DataFrame]:
    """Rows of (doc_id, source, hash, range), with ``carry`` also ``row``, and the rows of each source and range of hashes.

    The hash is that of the id, or of the text where there is no id, so that one source's rows spread over ranges.
    """
    own = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    stand_in = F.concat(F.lit("?"), F.coalesce(F.col("text").cast("string"), F.lit(""))) if "text" in docs.columns else F.lit("?")
    hash_ = F.md5(F.coalesce(F.col("doc_id").cast("string"), stand_in))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), hash_.alias("hash"), *own)
    keyed = keyed.withColumn("range", F.conv(F.substring("hash", 1, 3), 16, 10).cast("int"))
    return keyed, spooled(keyed.groupBy("source", "range").agg(F.count(F.lit(1)).alias("n")), "ranges")


def divisor(shares: DataFrame) -> int:
    """The greatest common divisor of the weights: the least rest that one leaves takes the divisor's place until none leaves any."""
    found = shares.agg(F.min(F.when(F.col("w") > 0, F.col("w")))).first()[0] or 1
    while (rest := shares.agg(F.min(F.when(F.col("w") % found > 0, F.col("w") % found))).first()[0]) is not None:
        found = rest
    return found


def weighed(ranges: DataFrame, weights: Weights | None, block: int) -> DataFrame:
    """(source, n, blocks, w): weights by default are in the ratios of the whole parts of the square roots of the sources' rows."""
    sizes = ranges.groupBy("source").agg(F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block))
    if weights is None:
        rooted = sizes.withColumn("w", F.floor(F.sqrt("n")))
        return rooted.withColumn("w", F.expr(f"w div {divisor(rooted)}L"))
    stated = {source: w for source, w in exact(weights).items() if w}
    if not stated:
        return sizes.withColumn("w", F.lit(None).cast("long"))
    known = F.create_map(*(F.lit(x) for pair in sorted(stated.items()) for x in pair)).cast("map<string,bigint>")
    return sizes.withColumn("w", F.try_element_at(known, F.col("source")))


def _walk(classes: str, period: int, slots: int) -> Column:
    """The winner of each slot, earliest deadline first, as (blocks that its class has had) * classes + class.

    Sources of one weight form a class: their blocks of one number are released and due together and go in the
    sources' order. A fold over the slots holds how many blocks each class has had; what it has found is
    put away by stretches of slots, so that no long list is copied at every slot.
    """
    stretch = max(1, math.isqrt(slots))
    key = f"if((h div c.m) * {period}L div c.w <= t, (((h div c.m) + 1) * {period}L + c.w - 1) div c.w * size({classes}) + c.i, null)"
    step = f"""transform(array(array_min(zip_with(s.had, {classes}, (h, c) -> {key})) % size({classes})), k -> named_struct(
        'had', transform(s.had, (h, i) -> if(i = k, h + 1, h)), 'won', array_append(s.won, s.had[cast(k as int)] * size({classes}) + k)))[0]"""
    inner = f"aggregate(sequence(start, least(start + {stretch}L, {slots}L) - 1), named_struct('had', all.had, 'won', cast(array() as array<bigint>)), (s, t) -> {step})"
    outer = f"""aggregate(sequence(0L, {slots}L - 1, {stretch}L), named_struct('had', transform({classes}, c -> 0L), 'done', cast(array() as array<array<bigint>>)),
        (all, start) -> transform(array({inner}), r -> named_struct('had', r.had, 'done', array_append(all.done, r.won)))[0])"""
    return F.expr(f"flatten(({outer}).done)")


def schedule(shares: DataFrame) -> tuple[DataFrame, int, int]:
    """The slot of each source's blocks in a period, (source, turn, slot), the period, and the slots walked.

    The walk ends with the period, or when a source has run out. It is sequential by nature and takes (slots x
    different weights) steps in one task: at most LONGEST slots, of at most about the square root of so many
    different weights. What no such walk can hold is an error.
    """
    period = shares.agg(F.sum("w")).first()[0] or 0
    # the first block that a source lacks is due by then, in whole numbers
    missing = F.expr(f"(blocks + 1) div w * {period}L + ((blocks + 1) % w * {period}L + w - 1) div w")
    slots = min(period, shares.agg(F.min(missing)).first()[0] or 0) if period else 0
    if slots > LONGEST:
        raise ValueError(f"the schedule has {slots} slots, more than {LONGEST}: state weights as smaller whole numbers, or mix fewer sources")
    ranked = shares.filter("w is not null").select("source", "w", (F.row_number().over(Window.partitionBy("w").orderBy("source")) - 1).cast("long").alias("rank"))
    classes = ranked.groupBy("w").agg(F.count(F.lit(1)).alias("m"))
    one = classes.agg(F.sort_array(F.collect_list(F.struct("w", "m"))).alias("found")).filter(F.lit(slots > 0))
    one = one.select(F.expr("transform(found, (c, i) -> named_struct('w', c.w, 'm', c.m, 'i', cast(i as bigint)))").alias("classes"))
    won = one.select("classes", F.posexplode(_walk("classes", period, max(slots, 1))).alias("slot", "code")).withColumn("c", F.expr("classes[cast(code % size(classes) as int)]")).withColumn("had", F.expr("code div size(classes)"))
    turns = won.select(F.col("c.w").alias("w"), F.expr("had % c.m").alias("rank"), F.expr("had div c.m").alias("turn"), F.col("slot").cast("long").alias("slot"))
    return spooled(turns.join(ranked, ["w", "rank"]).select("source", "turn", "slot"), "schedule"), period, slots


def mix(docs: DataFrame, weights: Weights | None = None, block: int = BLOCK, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, block, slot, place, in_mix.

    (slot, place) is the order of the mix; each slot holds one block, the last of a source perhaps not full.
    Every row gets a place: nothing is dropped or repeated. ``in_mix`` holds for the slots before the first
    source has run out, over which each source is less than a block from its exact weight. Later blocks follow by
    deadline, in slots of which some are empty. Weights default to the whole part of the square root of each
    source's rows. A stated source that isn't there is ignored; one without a weight, or with weight zero, comes
    after all others. Sources are the parts of a mix: a schedule of more than LONGEST slots is an error.
    A null source counts as the source ''. A null doc_id stays null. Rows that repeat an id get places of their
    own. Other columns are ignored, or with ``carry`` kept in ``row``. An empty table gives an empty one.
    """
    keyed, ranges = counted(docs, carry)
    shares = weighed(ranges, weights, block)
    # one row for each source, which are few: see LONGEST
    shares = spooled(shares.withColumn("i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("w").asc_nulls_last(), "source"))), "shares")
    turns, period, slots = schedule(shares)
    small = (lambda df: F.broadcast(df)) if slots <= BROADCAST else (lambda df: df)  # else Spark's joins by (source, turn)
    turns = turns.select("source", "turn", F.col("slot").alias("own"))

    def by_schedule(number: str) -> Column:
        return F.expr(f"({number}) div w * {period}L + own")

    def by_deadline(number: str, horizon: int, sources: int) -> Column:
        due = f"(({number}) + 1) div w * {period}L + ((({number}) + 1) % w * {period}L + w - 1) div w"
        return F.expr(f"{horizon}L + ({due} - {horizon}L - 1) * {sources}L + i - 1")

    def slot_of(number: str, horizon: int, sources: int) -> Column:
        early = by_schedule(number)
        return F.when(early < horizon, early).otherwise(by_deadline(number, horizon, sources))

    mixed = shares.filter("w is not null")
    sources = mixed.count()
    lacking = mixed.withColumn("turn", F.expr("blocks % w")).join(turns, ["source", "turn"])
    horizon = lacking.agg(F.min(by_schedule("blocks"))).first()[0] or 0
    final = mixed.withColumn("turn", F.expr("(blocks - 1) % w")).join(turns, ["source", "turn"], "left")
    last = final.agg(F.max(slot_of("blocks - 1", horizon, sources)) + 1).first()[0] or 0
    earlier = F.sum(F.when(F.col("w").isNull(), F.col("blocks"))).over(Window.partitionBy(F.col("w").isNull()).orderBy("source")) - F.col("blocks")
    before = ranges.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")).select("source", "range", "before")
    before = before.join(small(shares.select("source", "w", "i", F.when(F.col("w").isNull(), earlier + last).alias("base"))), "source")
    # rows that repeat an id are told apart by what they hold, so that a task that runs again comes to the same order
    within = F.row_number().over(Window.partitionBy("source", "range").orderBy("hash", "doc_id", *([F.xxhash64("row")] if carry else [])))
    at = F.col("before") + F.col("within") - 1
    rows = keyed.withColumn("within", within).join(before, ["source", "range"])
    rows = rows.withColumn("block", F.floor(at / block)).withColumn("place", (at % block).cast("int")).withColumn("turn", F.expr("block % w"))
    placed = rows.join(small(turns), ["source", "turn"], "left")
    placed = placed.withColumn("slot", F.coalesce(slot_of("block", horizon, sources), F.col("base") + F.col("block")))
    return placed.select(
        "doc_id", "source", F.col("block").cast("long").alias("block"), F.col("slot").cast("long").alias("slot"), "place",
        (F.col("w").isNotNull() & (F.col("slot") < horizon)).alias("in_mix"), *(["row"] if carry else []),
    )


def in_mixed_order(docs: DataFrame, weights: Weights | None = None, block: int = BLOCK) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mix, over range partitions in that order."""
    return mix(docs, weights, block, carry=True).orderBy("slot", "place").select("row.*")
