"""The registered queries of this subpackage: each applies one operator to a whole table of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, masked_lm, packing, pii, quality_classifier, quality_rules, secret_scan, simhash_dedup, slot_sharding, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; it is read where it lies, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op6_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_sharding.shard(_table(spark, sf_dir, "documents"))


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_masked_pseudo_likelihood, op2_decontamination, op3_simhash_dedup, op4_quality_classifier, op5_pii_spans, op6_slot_sharding, op7_curve_packing, op8_secret_spans, op9_quality_rules, op10_token_counts)}

#: Queries that SQL can express over whole tables; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {}
