"""Building relationships: typed edges, co-occurrence edges, triples, and their evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import docids, names

S, T = "source_entity_id", "target_entity_id"


def typed_edges(raw: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of a curated graph with both ends mapped by ``ids`` (id, canonical_id), and those left unmapped.

    Weight, dates and type pass; ``metadata`` is JSON with efta, original_type and notes.
    """
    m = lambda end: ids.select(F.col("id").alias(f"{end}_entity_id"), F.col("canonical_id").alias(f"{end}_cid"))
    joined = raw.join(m("source"), S, "left").join(m("target"), T, "left")
    field = lambda name: F.get_json_object("metadata", f"$.{name}")
    ref = field("efta")
    key = docids.doc_key(docids.extract_efta(ref), docids.extract_doj_ogr(ref), ref)
    edges = joined.where("source_cid is not null and target_cid is not null").select(
        "id", F.col("source_cid").alias(S), F.col("target_cid").alias(T), "relationship_type", field("original_type").alias("relationship_subtype"),
        F.col("date_first").alias("date_start"), F.col("date_last").alias("date_end"), "weight", F.lit(config.EDGE_CONFIDENCE["registry"]).alias("confidence_score"),
        F.when(ref.isNotNull() & (ref != ""), F.array(key)).otherwise(F.array().cast("array<string>")).alias("source_documents"), field("notes").alias("notes"),
    )
    return edges, joined.where("source_cid is null or target_cid is null").select(*raw.columns)


def cooccurrence_pairs(mentions: DataFrame) -> DataFrame:
    """(a, b, doc_key): pairs of different entities inside each document; repeats count repeatedly.

    ``mentions`` has (doc_key, pos, canonical_id). Pairs are made only within a document.
    """
    left, right = mentions.select("doc_key", F.col("pos").alias("i"), F.col("canonical_id").alias("x")), mentions.select("doc_key", F.col("pos").alias("j"), F.col("canonical_id").alias("y"))
    return left.join(right, "doc_key").where("i < j and x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "doc_key")


def cooccurrence_edges(mentions: DataFrame, sample: int = config.SAMPLE) -> DataFrame:
    """One row per pair: weight (occurrences), documents, and the first ``sample`` document keys in order."""
    by_document = cooccurrence_pairs(mentions).groupBy("a", "b", "doc_key").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("doc_key"))
    return by_document.withColumn("r", rank).groupBy("a", "b").agg(
        F.sum("n").alias("weight"), F.count("*").alias("document_count"), F.sort_array(F.collect_list(F.when(F.col("r") <= sample, F.col("doc_key")))).alias("doc_key_sample")
    )


def against_existing(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``pairs`` with the smallest existing relationship of the pair (any type) or null, and whether it is a co-occurrence."""
    first = edges.select(F.least(S, T).alias("a"), F.greatest(S, T).alias("b"), "relationship_id", "relationship_type").groupBy("a", "b").agg(F.min_by(F.struct("relationship_id", "relationship_type"), "relationship_id").alias("e"))
    return pairs.join(first, ["a", "b"], "left").select(*pairs.columns, F.col("e.relationship_id").alias("relationship_id"), (F.col("e.relationship_type") == "co_documented").alias("co_documented"))


def apply_cooccurrence(pairs: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New ``co_documented`` edges, and (relationship_id, added weight) for existing ones.

    Only an existing co-occurrence grows, by its occurrences but the first.
    """
    known = against_existing(pairs, edges)
    new = known.where("relationship_id is null").select(F.col("a").alias(S), F.col("b").alias(T), F.lit("co_documented").alias("relationship_type"), F.col("weight").cast("double").alias("weight"), F.lit(config.EDGE_CONFIDENCE["documents"]).alias("confidence_score"))
    grown = known.where("co_documented").select("relationship_id", (F.col("weight") - 1).alias("added"))
    return new, grown


def triple_rows(triples: DataFrame, ids: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(a, b, relationship_type, action, actor, target, seq, ...) of triples (seq, actor, action, target, ...): names mapped, direction dropped.

    ``ids`` maps lower-case names to canonical ids; ``aliases`` maps raw names to preferred ones. Other columns are kept.
    """
    more = [c for c in triples.columns if c not in ("seq", "actor", "action", "target")]
    rows = triples.where(~names.is_redaction_marker(F.col("actor")) & ~names.is_redaction_marker(F.col("target")) & ~names.is_noise_name(F.col("actor")) & ~names.is_noise_name(F.col("target")))
    for end in ("actor", "target"):
        name = names.strip(F.col(end))
        if aliases is not None:
            rows = rows.join(aliases.select(F.col("original_name").alias(end), F.col("canonical_name").alias("__preferred")), end, "left")
            name = F.coalesce("__preferred", name)
        rows = rows.withColumn(f"{end}_form", F.lower(name)).join(ids.select(F.col("form").alias(f"{end}_form"), F.col("canonical_id").alias(f"{end}_id")), f"{end}_form").drop("__preferred")
    return rows.where("actor_id <> target_id").select(F.least("actor_id", "target_id").alias("a"), F.greatest("actor_id", "target_id").alias("b"), names.action_type(F.col("action")).alias("relationship_type"), "action", "actor", "target", "seq", *more)


KEYS = ["a", "b", "relationship_type"]


def triple_edges(triples: DataFrame, ids: DataFrame, aliases: DataFrame | None = None, cap: int = config.TRIPLE_CAP) -> DataFrame:
    """Edges from (seq, actor, action, target), typed by the action, weight capped."""
    return edges_of_triples(triple_rows(triples, ids, aliases), cap)


def edges_of_triples(rows: DataFrame, cap: int = config.TRIPLE_CAP) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.least(F.count("*"), F.lit(cap)).cast("double").alias("weight"), F.min_by("action", "seq").alias("relationship_subtype"), F.count("*").alias("n_triples"))


def first_documents(rows: DataFrame, keys: list[str], cap: int = config.DOCUMENT_CAP) -> DataFrame:
    """(keys, document_count, doc_key_sample, doc_keys) of (keys, doc_key): the first keys as text, and by class."""
    distinct = rows.where("doc_key is not null").select(*keys, "doc_key").distinct()
    by_class = F.row_number().over(Window.partitionBy(*keys).orderBy(docids.document_class(F.col("doc_key")), F.upper("doc_key"), "doc_key"))
    by_text = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_key"))
    ranked = distinct.withColumn("c", by_class).withColumn("t", by_text)
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("document_count"), F.sort_array(F.collect_list(F.when(F.col("t") <= config.SAMPLE, F.col("doc_key")))).alias("doc_key_sample"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("c") <= cap, F.struct("c", "doc_key")))), lambda x: x["doc_key"]).alias("doc_keys"),
    )


def triple_evidence(rows: DataFrame) -> DataFrame:
    """(a, b, relationship_type, doc_keys, source_evidence, notes) of ``triple_rows`` with doc_key: documents, a sample, counts of actions."""
    actions = action_counts(rows.withColumn("action", F.lower("action")), KEYS)
    first = rows.groupBy(*KEYS).agg(F.min_by(F.concat_ws(" → ", "actor", "action", "target"), "seq").alias("first"))
    joined = first.join(first_documents(rows, KEYS), KEYS, "left").join(actions, KEYS, "left")
    evidence = F.to_json(F.struct(F.lit("triple").alias("type"), F.coalesce("document_count", F.lit(0)).alias("document_count"), F.coalesce("doc_key_sample", F.array().cast("array<string>")).alias("doc_key_sample"), "action_counts"))
    return joined.select(*KEYS, F.coalesce("doc_keys", F.array().cast("array<string>")).alias("doc_keys"), evidence.alias("source_evidence"), F.concat(F.lit("First triple: "), "first").alias("notes"))


def top_actions(triples: DataFrame, keys: list[str], n: int = config.TOP_ACTIONS) -> DataFrame:
    """The ``n`` most frequent actions of each key; ties in order of first appearance (``seq``)."""
    counted = triples.groupBy(*keys, "action").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "first"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= n).drop("first")


def action_counts(triples: DataFrame, keys: list[str], n: int = config.TOP_ACTIONS) -> DataFrame:
    """``top_actions`` as one map per key."""
    return top_actions(triples, keys, n).groupBy(*keys).agg(F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("rank", "action", "n"))), lambda e: F.struct(e["action"], e["n"]))).alias("action_counts"))


def role_counts(mentions: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(canonical_id, observed_roles): how often each role was seen, added to what is known."""
    rows = mentions.where("role is not null and role <> ''").groupBy("canonical_id", "role").agg(F.count("*").alias("n"))
    if existing is not None:
        rows = rows.unionByName(existing.select("canonical_id", F.explode("observed_roles").alias("role", "n"))).groupBy("canonical_id", "role").agg(F.sum("n").alias("n"))
    return rows.groupBy("canonical_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role", "n")))).alias("observed_roles"))


def document_rollup(rows: DataFrame, key: str = "relationship_id", sample: int = config.SAMPLE) -> DataFrame:
    """(key, document_count, doc_key_sample): distinct documents, the first of them in order."""
    distinct = rows.select(key, "doc_key").distinct()
    ranked = distinct.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("doc_key")))
    return ranked.groupBy(key).agg(F.count("*").alias("document_count"), F.sort_array(F.collect_list(F.when(F.col("r") <= sample, F.col("doc_key")))).alias("doc_key_sample"))


def append_documents(edges: DataFrame, documents: DataFrame, cap: int = config.DOCUMENT_CAP) -> DataFrame:
    """``edges`` with (relationship_id, doc_keys) merged into ``source_documents``."""
    joined = edges.join(documents, "relationship_id", "left")
    return joined.withColumn("source_documents", docids.merge_documents(F.col("source_documents"), F.col("doc_keys"), cap)).select(*edges.columns)
