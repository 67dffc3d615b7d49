"""Corroboration: evidence points, scores, weak relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from . import graph

S, T = "source_entity_id", "target_entity_id"


def evidence_points(sources: DataFrame) -> DataFrame:
    """(relationship_id, num_sources, evidence_points, classes): the best weight of each source, summed."""
    kind = scoring.evidence_class(F.col("evidence_class"), F.col("source_system"))
    best = sources.select("relationship_id", "source_system", kind.alias("kind")).withColumn("w", scoring.evidence_weight(F.col("kind")))
    per = best.groupBy("relationship_id", "source_system").agg(F.max("w").alias("w"), F.collect_set("kind").alias("kinds"))
    return per.groupBy("relationship_id").agg(F.count("*").alias("num_sources"), F.sum("w").alias("evidence_points"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("classes"))


def document_keys(edges: DataFrame, sources: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """(relationship_id, num_documents): distinct keys in the edges' documents (or ``documents``) and in their evidence."""
    own = edges.select("relationship_id", F.explode("source_documents").alias("doc_key")) if documents is None else documents.select("relationship_id", "doc_key")
    told = sources.select("relationship_id", F.explode(scoring.evidence_doc_keys(F.col("source_evidence"))).alias("doc_key"))
    return own.unionByName(told).where("doc_key is not null and doc_key <> ''").groupBy("relationship_id").agg(F.count_distinct("doc_key").alias("num_documents"))


def corroboration(edges: DataFrame, entities: DataFrame, sources: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """A scored record for each relationship whose ends are both known.

    ``documents`` (relationship_id, doc_key) stands for the edges' own arrays where they are rows already. Edges meet
    their points and documents under one key, and then one table of nodes (name, type, prominence) at either end.
    """
    nodes = entities.select("canonical_id", "canonical_name", "entity_type").join(graph.prominence(edges), "canonical_id", "left")
    node = lambda end, out: nodes.select(F.col("canonical_id").alias(end), F.col("canonical_name").alias(f"{out}_name"), F.col("entity_type").alias(f"{out}_type"), F.col("prominence").alias(f"{out}_prominence"))
    known = edges.select("relationship_id", S, T, "relationship_type", "weight").join(evidence_points(sources), "relationship_id", "left").join(document_keys(edges, sources, documents), "relationship_id", "left")
    known = known.join(node(S, "source"), S).join(node(T, "target"), T)
    n, p, d = (F.coalesce(c, F.lit(0)) for c in ("num_sources", "evidence_points", "num_documents"))
    return known.select(
        "relationship_id", S, "source_name", "source_type", T, "target_name", "target_type", "relationship_type", "weight", n.alias("num_sources"), p.cast("double").alias("evidence_points"), d.alias("num_documents"),
        F.coalesce("classes", F.array().cast("array<string>")).alias("classes"), F.coalesce("source_prominence", F.lit(0)).alias("source_prominence"), F.coalesce("target_prominence", F.lit(0)).alias("target_prominence"),
        scoring.corroboration_score(n, p.cast("double"), d).alias("corroboration_score"),
    )


def ranked(records: DataFrame) -> DataFrame:
    return records.orderBy(F.desc("corroboration_score"), F.desc("evidence_points"), F.desc_nulls_last("weight"), "relationship_id")


def weak(records: DataFrame, min_prominence: int = 20) -> DataFrame:
    """Single-source relationships of prominent entities, co-occurrence alone excepted."""
    prominent = F.greatest("source_prominence", "target_prominence")
    only: Column = (F.size("classes") == 1) & (F.get("classes", F.lit(0)) == "cooccurrence")
    return records.where((F.col("num_sources") == 1) & (prominent >= min_prominence) & ~only).withColumn("max_entity_prominence", prominent)


def score_histogram(records: DataFrame) -> DataFrame:
    return records.groupBy(F.round("corroboration_score", 1).alias("score")).agg(F.count("*").alias("n"))
