"""Integrity checks and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph

S, T = "source_entity_id", "target_entity_id"


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def resolution_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("source_system", "match_method").agg(F.count("*").alias("n"), F.round(F.avg("match_confidence"), 3).alias("avg_confidence"))


def fuzzy_review(log: DataFrame, entities: DataFrame) -> DataFrame:
    """Fuzzy matches with both names, least certain first."""
    rows = log.where("match_method = 'fuzzy'").join(entities.select("canonical_id", "canonical_name"), "canonical_id")
    return rows.select("source_system", "source_entity_name", "canonical_name", "canonical_id", "match_confidence").orderBy("match_confidence", "source_entity_name", "canonical_id")


def multi_source(edges: DataFrame, sources: DataFrame, entities: DataFrame, least: int = 2) -> DataFrame:
    """Relationships that ``least`` systems or more attest, with the ends' names."""
    n = sources.groupBy("relationship_id").agg(F.count_distinct("source_system").alias("source_count")).where(F.col("source_count") >= least)
    name = lambda end, out: entities.select(F.col("canonical_id").alias(end), F.col("canonical_name").alias(out))
    return edges.join(n, "relationship_id").join(name(S, "source_name"), S).join(name(T, "target_name"), T).select("relationship_id", "source_name", "target_name", "relationship_type", "source_count")


def orphans(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Relationships of which an end is no entity."""
    lacks = lambda end: edges.join(entities.select(F.col("canonical_id").alias(end)), end, "left_anti").select("relationship_id", S, T)
    return lacks(S).unionByName(lacks(T)).distinct()


def duplicate_names(entities: DataFrame) -> DataFrame:
    """Names, in any case, that several entities of a type have; their ids in order."""
    rows = entities.groupBy(F.lower("canonical_name").alias("name"), "entity_type").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("canonical_id")), ", ").alias("ids"))
    return rows.where("n > 1")


def without_log(entities: DataFrame, log: DataFrame) -> DataFrame:
    return entities.join(log.select("canonical_id"), "canonical_id", "left_anti")


def report(tables: dict[str, DataFrame], top_n: int = 20) -> dict[str, DataFrame]:
    """All checks by name."""
    e, r, s, g = (tables[t] for t in ("canonical_entities", "relationships", "relationship_sources", "entity_resolution_log"))
    return {
        "entities_by_type": count_by(e, "entity_type"),
        "resolution": resolution_summary(g),
        "relationships_by_type": count_by(r, "relationship_type"),
        "fuzzy_review": fuzzy_review(g, e),
        "multi_source": multi_source(r, s, e).orderBy(F.desc("source_count"), "relationship_id").limit(top_n),
        "orphans": orphans(r, e),
        "duplicate_names": duplicate_names(e),
        "without_log": without_log(e, g),
        "top_connected": graph.top_connected(e, r, top_n),
    }


# ---- consumer queries --------------------------------------------------------------------------


def connections(edges: DataFrame, entities: DataFrame, canonical_id: str, both: bool = True) -> DataFrame:
    """Relationships of an entity with the other end's name: outgoing ones, or both directions."""
    name = entities.select(F.col("canonical_id").alias("other_id"), F.col("canonical_name").alias("other_name"))
    out = edges.where(F.col(S) == canonical_id).select("relationship_id", "relationship_type", "weight", F.col(T).alias("other_id"), F.lit("out").alias("direction"))
    if both:
        out = out.unionByName(edges.where(F.col(T) == canonical_id).select("relationship_id", "relationship_type", "weight", F.col(S).alias("other_id"), F.lit("in").alias("direction")))
    return out.join(name, "other_id")


def resolution_trace(log: DataFrame, canonical_id: str) -> DataFrame:
    return log.where(F.col("canonical_id") == canonical_id)


def unresolved_conflicts(conflicts: DataFrame) -> DataFrame:
    return conflicts.where("resolution_status = 'unresolved'")


def merge_history(merges: DataFrame) -> DataFrame:
    return merges.where("survivor_id <> 'NOISE_DELETED'").orderBy(F.desc("merged_at"), "absorbed_id")


def evidence_breakdown(edges: DataFrame, sources: DataFrame, least: int = 2) -> DataFrame:
    """Relationships with several evidence classes, the classes in order."""
    by = sources.groupBy("relationship_id").agg(F.array_join(F.array_sort(F.collect_set("evidence_class")), ", ").alias("classes"), F.count_distinct("evidence_class").alias("n"))
    return edges.join(by.where(F.col("n") >= least), "relationship_id").select("relationship_id", "relationship_type", "classes", F.col("n").alias("n_classes"))
