"""Research priority: bonuses of several factors added up per name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import is_ranking_noise
from . import graph

_NONE = "cast(null as string)"


def _factor(rows: DataFrame, order: int, name: str, bonus, text, cid=None) -> DataFrame:
    """(name, canonical_id, bonus, ord, factor) without noise names."""
    out = rows.where(~is_ranking_noise(F.col(name)))
    return out.select(F.col(name).alias("name"), (cid if cid is not None else F.expr(_NONE)).alias("canonical_id"), bonus.cast("double").alias("bonus"), F.lit(order).alias("ord"), text.alias("factor"))


def prominence_factor(entities: DataFrame, edges: DataFrame, excluded: DataFrame) -> DataFrame:
    persons = entities.where("entity_type = 'person'").join(excluded, "canonical_id", "left_anti").join(graph.prominence(edges), "canonical_id")
    return _factor(persons, 1, "canonical_name", F.least(F.log2(F.col("prominence") + 1) * 2, F.lit(20.0)), F.expr(_NONE), F.col("canonical_id"))


def coverage_factor(coverage: DataFrame) -> DataFrame:
    n = F.col("unanalyzed_count")
    return _factor(coverage.where(n >= 10), 2, "canonical_name", F.least(n / 10, F.lit(30.0)), F.concat(F.lit("document_gap:"), n, F.lit("_unanalyzed")), F.col("canonical_id"))


def corpus_factor(mentions: DataFrame) -> DataFrame:
    """``mentions`` has canonical_id, canonical_name, document_count, n_edges."""
    d, r = F.col("document_count"), F.col("n_edges")
    return _factor(mentions.where((d > 20) & (r < d / 10)), 3, "canonical_name", F.least(d / 50, F.lit(25.0)), F.concat(F.lit("corpus_mentions:"), d, F.lit("_docs/"), r, F.lit("_rels")), F.col("canonical_id"))


def _per_name(rows: DataFrame, columns: list[str], order: int, least: int, each: int, cap: int, label: str) -> DataFrame:
    counts = rows.select(F.explode(F.array(*columns)).alias("name")).groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return _factor(counts, order, "name", F.least(F.col("n") * each, F.lit(cap)), F.concat(F.lit(f"{label}:"), "n"))


def weak_factor(weak: DataFrame) -> DataFrame:
    return _per_name(weak, ["source_name", "target_name"], 4, 2, 3, 20, "weak_relationships")


def gap_factor(gaps: DataFrame) -> DataFrame:
    return _per_name(gaps, ["entity_a", "entity_b"], 5, 1, 5, 25, "structural_gaps")


def bridge_factor(bridges: DataFrame) -> DataFrame:
    n = F.col("communities_connected")
    return _factor(bridges.where(n >= 3), 6, "entity", F.least(n * 3, F.lit(15)), F.concat(F.lit("bridges:"), n, F.lit("_communities")))


def contradiction_factor(contradictions: DataFrame) -> DataFrame:
    """Every row counts, without a cap, for its first entity."""
    s = F.col("severity")
    return _factor(contradictions, 7, "entity_a", F.when(s == "high", 10).when(s == "medium", 5).when(s == "low", 2).otherwise(1), F.concat(F.lit("contradiction:"), "field", F.lit(":"), s))


def priorities(factors: list[DataFrame]) -> DataFrame:
    """Sum of all bonuses by name; rows that no factor gives an entity for are dropped. Factors in order."""
    every = factors[0]
    for f in factors[1:]:
        every = every.unionByName(f)
    grouped = every.groupBy("name").agg(
        F.sum("bonus").alias("priority_score"), F.min_by("canonical_id", F.when(F.col("canonical_id").isNotNull(), F.struct("ord", "canonical_id"))).alias("canonical_id"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("factor").isNotNull(), F.struct("ord", "factor")))), lambda x: x["factor"]), "; ").alias("factors"),
    )
    return grouped.where("priority_score > 0 and canonical_id is not null").select("canonical_id", F.col("name").alias("canonical_name"), "priority_score", "factors")


def top(rows: DataFrame, n: int = 50) -> DataFrame:
    return rows.orderBy(F.desc("priority_score"), "canonical_name").limit(n)
