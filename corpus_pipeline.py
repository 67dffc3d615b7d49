"""The corpus pipeline: quality classifier, near-dedup, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes each
result as Parquet in the shared folder and reads it again as the next stage's ``docs``.

Defined results: without labels every score is 0.5 and all documents are accepted; null and blank texts are one group, of
which the smallest id stays; null ids are kept like any other; without a benchmark nothing is contaminated; a blank
text is packed as its closing id; an empty table gives no rows; further columns pass all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corroba.llm import decontamination, packing, pii, quality_classifier, simhash_dedup
from corroba.llm._frames import written
from corroba.llm.queries import vocabulary


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality_classifier.fit(docs, labels, among=~quality_classifier.held_out())
    return quality_classifier.accepted(docs, weights)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, linked at a five-word shingle similarity of 0.8."""
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of up to 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", accept),
    ("SimHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("PII", redact),
    ("packing", pack),
]

#: Training, fingerprints and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
