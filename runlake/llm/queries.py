"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, embedding_dedup, hard_negatives, license_scan, mixing, oracles, quality_mil, quality_rules, secret_scan, sharding, simhash, warc, weighted_sampling
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_secret_scan": op2_secret_scan,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_warc": op7_warc,
    "op8_license_scan": op8_license_scan,
    "op9_quality_mil": op9_quality_mil,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = oracles.ORACLES
