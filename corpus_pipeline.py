"""A corpus pipeline of five stages over the documents table, each written as Parquet before the next.

Documents that the quality rules reject go; of each group of near-duplicates one document stays; secrets
are masked in the texts; the documents are put into the order of the mix; and every text is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlake.llm import byte_bpe, mixing, quality_rules, secret_scan, simhash
from runlake.llm.common import shared_dir, table
from runlake.session import ship


#: Near copies are texts whose fingerprints differ in at most so many of 64 bits, more than operator 5's contract has,
#: or that share at least so much of their five-word shingles. The README has figures of both.
RADIUS, SIMILAR = 6, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the counts and the trained classifier find good."""
    return quality_rules.keep_good(docs, table(ship(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group that near fingerprints or similar shingles link.

    Documents without an id get one from their text that is larger than any real one, so they give way to
    documents with an id. Of rows that repeat an id and a text one stays, the first by its other columns; of different
    texts of one id, one in each group that has that id as its smallest.
    """
    ship(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    stand_in = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    named = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), stand_in), "__text": F.sha2(text, 256)})
    found = simhash.near_duplicates(named.select(F.col("__id").alias("doc_id"), "text", "__text"), RADIUS, carry="__text", similar=SIMILAR)
    kept = found.filter("kept").groupBy("root").agg(F.min("doc_id").alias("__id"), F.min("__text").alias("__text")).select("__id", "__text").distinct()
    left = named.join(kept, ["__id", "__text"], "left_semi")
    others = F.to_json(F.struct([c for c in docs.columns if c != "text"]))
    return left.groupBy("__id", "__text").agg(F.min_by(F.struct(docs.columns), others).alias("__row")).select("__row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret found and counts the characters again."""
    ship(spark)
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: each source as often as its weight, to within a block."""
    return mixing.in_mixed_order(docs)


def as_written(docs: DataFrame) -> DataFrame:
    """A table read from Parquet in the order in which its rows were written; any other one as it is.

    A reader deals files out by size. The names of Spark's files hold the number of the partition.
    """
    try:
        at = docs.metadataColumn("_metadata")
        placed = docs.select(F.struct("*").alias("row"), at["file_name"].alias("file"), at["row_index"].alias("at"))
    except AnalysisException:  # not from files: no order to restore
        return docs
    part = F.expr("try_cast(regexp_extract(file, 'part-([0-9]+)', 1) as bigint)")
    return placed.orderBy(part, "file", "at").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, their number and hash, and whether decoding gives the text back, in the mix's order."""
    ship(spark)
    return byte_bpe.encode_texts(as_written(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing_sources", mix),
    ("byte_level_bpe", encode),
]

#: SQL expresses neither the classifier nor the search nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over all of the documents table, in the mix's order."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
