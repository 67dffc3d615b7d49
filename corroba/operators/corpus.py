"""Full-text enrichment: one tokenised pass over the pages answers all phrases at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from . import graph

MIN_NAME = 4
KEY = 3  # tokens of a phrase that pages are searched for first


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def search_names(entities: DataFrame, min_length: int = MIN_NAME) -> DataFrame:
    """(canonical_id, pos, term): the name and its aliases of ``min_length`` characters or more, in order."""
    every = F.concat(F.array("canonical_name"), F.filter(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.length(a) > 3))
    return entities.select("canonical_id", F.posexplode(every).alias("pos", "term")).where(F.length("term") >= min_length)


def phrase_hits(pages: DataFrame, terms: DataFrame) -> DataFrame:
    """(page, doc, term), distinct: terms, of any length, whose tokens stand one after another on a page.

    ``pages`` has (page, doc, text); ``terms`` has (term). Pages and terms meet on a term's first ``KEY`` tokens, or all
    where it has fewer, so a frequent word alone is no key; longer terms are then looked for in their candidates' pages.
    """
    phrases = terms.select("term").distinct().withColumn("t", tokens(F.col("term"))).where(F.size("t") > 0)
    phrases = phrases.select("term", F.size("t").alias("size"), F.array_join("t", " ").alias("phrase"), F.array_join(F.slice("t", 1, KEY), " ").alias("key"))
    sizes = sorted(r.n for r in phrases.select(F.least("size", F.lit(KEY)).alias("n")).distinct().collect())  # KEY rows at most
    longer = bool(phrases.where(F.col("size") > KEY).head(1))
    split = pages.select("page", "doc", tokens(F.col("text")).alias("t"))
    none = F.array().cast("array<string>")

    def runs(n: int) -> Column:
        starts = F.slice("t", F.lit(1), F.greatest(F.size("t") - (n - 1), F.lit(0)))
        return F.col("t") if n == 1 else F.transform(starts, lambda x, i: F.concat_ws(" ", x, *(F.get("t", i + k) for k in range(1, n))))

    every = split.select("page", "doc", F.explode(F.array_distinct(F.concat(none, *map(runs, sizes)))).alias("key"))
    found = every.join(phrases, "key").select("page", "doc", "term", "phrase", "size")
    if longer:
        spaced = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
        whole = split.select("page", "doc", spaced(F.array_join("t", " ")).alias("spaced"))
        found = found.join(whole, ["page", "doc"]).where((F.col("size") <= KEY) | F.contains("spaced", spaced(F.col("phrase"))))
    return found.select("page", "doc", "term").distinct()


def substring_hits(pages: DataFrame, terms: DataFrame, block: int = 500) -> DataFrame:
    """Fallback without an index: terms found anywhere in the text, ASCII case folded. About ``block`` terms are broadcast at a time."""
    fold = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    every, low = terms.select("term").distinct(), pages.select("page", "doc", fold(F.col("text")).alias("low"))
    parts = max(1, -(-every.count() // block))
    out = None
    for k in range(parts):
        few = F.broadcast(every.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == k))
        found = low.join(few, F.contains("low", fold(F.col("term")))).select("page", "doc", "term")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def document_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("term").agg(F.count_distinct("doc").alias("document_count"))


def best_search_term(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(canonical_id, search_term, document_count): the variant found in most documents, the first of equals."""
    joined = names.join(counts, "term")
    return joined.groupBy("canonical_id").agg(F.max_by("term", F.struct(F.col("document_count"), -F.col("pos"))).alias("search_term"), F.max("document_count").alias("document_count"))


def phrase_cooccurrence(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (term_a, term_b) with the documents that have both on one page: count and first documents."""
    a, b = hits.select("page", "doc", F.col("term").alias("term_a")), hits.select("page", F.col("term").alias("term_b"))
    docs = pairs.join(a, "term_a").join(b, ["page", "term_b"]).select("term_a", "term_b", "doc").distinct()
    ranked = docs.withColumn("r", F.row_number().over(Window.partitionBy("term_a", "term_b").orderBy("doc")))
    return ranked.groupBy("term_a", "term_b").agg(F.count("*").alias("document_count"), F.sort_array(F.collect_list(F.when(F.col("r") <= config.SAMPLE, F.col("doc")))).alias("sample"))


def mention_counts(entities: DataFrame, edges: DataFrame, pages: DataFrame, top_n: int = 1000) -> DataFrame:
    """Best search term and document count of the ``top_n`` best connected persons that are mentioned."""
    persons = graph.with_incident_edges(entities.where("entity_type = 'person'"), edges).orderBy(F.desc("n_edges"), "canonical_id").limit(top_n)
    names = search_names(persons)
    return best_search_term(names, document_counts(phrase_hits(pages, names)))


def corroborate(entities: DataFrame, edges: DataFrame, sources: DataFrame, pages: DataFrame, limit: int = 3000) -> DataFrame:
    """New corpus provenance for person-person relationships with up to two sources whose names share a page."""
    person = lambda end, out: entities.where("entity_type = 'person'").select(F.col("canonical_id").alias(end), F.col("canonical_name").alias(out))
    per = sources.groupBy("relationship_id").agg(F.count_distinct("source_system").alias("n_sources"), F.max((F.col("source_system") == "corpus").cast("int")).alias("known"))
    degree = graph.incident_edges(edges).select(F.col("canonical_id").alias("source_entity_id"), F.col("n_edges").alias("source_degree"))
    picked = edges.join(per, "relationship_id").where("n_sources <= 2").join(person("source_entity_id", "term_a"), "source_entity_id").join(person("target_entity_id", "term_b"), "target_entity_id").join(degree, "source_entity_id")
    picked = picked.orderBy("n_sources", F.desc("source_degree"), "relationship_id").limit(limit)
    terms = picked.select(F.explode(F.array("term_a", "term_b")).alias("term"))
    found = phrase_cooccurrence(phrase_hits(pages, terms), picked.select("term_a", "term_b").distinct())
    return picked.where("known = 0").join(found, ["term_a", "term_b"]).select("relationship_id", F.lit("corpus").alias("source_system"), F.lit("co_occurrence").alias("source_relationship_type"), F.lit(config.EDGE_CONFIDENCE["corpus_known"]).alias("source_confidence"), F.lit("corpus_cooccurrence").alias("evidence_class"), "document_count", "sample")


def discover(entities: DataFrame, mentions: DataFrame, edges: DataFrame, pages: DataFrame, top_entities: int = 100, top_hubs: int = 50, min_documents: int = 3, min_mentions: int = 10) -> DataFrame:
    """New co-occurrence edges between much mentioned, little connected persons and hubs without an edge."""
    persons = graph.with_incident_edges(entities.where("entity_type = 'person'"), edges)
    quiet = persons.join(mentions.select("canonical_id", "document_count"), "canonical_id").where((F.col("document_count") > min_mentions) & (F.col("n_edges") < 5)).orderBy(F.desc("document_count"), "canonical_id").limit(top_entities)
    hubs = persons.where("n_edges > 0").orderBy(F.desc("n_edges"), "canonical_id").limit(top_hubs)
    open_ = graph.hub_pairs_without_edge(quiet, hubs, edges).select(F.least("canonical_id", "hub_id").alias("a"), F.greatest("canonical_id", "hub_id").alias("b")).distinct()
    name = lambda end, out: entities.select(F.col("canonical_id").alias(end), F.col("canonical_name").alias(out))
    named = open_.join(name("a", "term_a"), "a").join(name("b", "term_b"), "b")
    hits = phrase_hits(pages, named.select(F.explode(F.array("term_a", "term_b")).alias("term")))
    found = phrase_cooccurrence(hits, named.select("term_a", "term_b").distinct()).where(F.col("document_count") >= min_documents)
    return named.join(found, ["term_a", "term_b"]).select(F.col("a").alias("source_entity_id"), F.col("b").alias("target_entity_id"), F.lit("co_documented").alias("relationship_type"), F.col("document_count").cast("double").alias("weight"), F.lit(config.EDGE_CONFIDENCE["corpus_new"]).alias("confidence_score"), F.col("sample").alias("source_documents"))


def graph_documents(edges: DataFrame) -> DataFrame:
    """(canonical_id, documents_in_graph): distinct EFTA keys over an entity's relationships."""
    ends = edges.select(F.explode(F.array_distinct(F.array("source_entity_id", "target_entity_id"))).alias("canonical_id"), "source_documents")
    return ends.select("canonical_id", F.explode("source_documents").alias("d")).where(F.col("d").startswith("EFTA")).groupBy("canonical_id").agg(F.count_distinct("d").alias("documents_in_graph"))


def coverage(entities: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """Mentions against documents in the graph; the ratio may exceed 1, as the sets are not intersected."""
    return _covered(graph.with_incident_edges(entities, edges), mentions, edges)


def _covered(entities: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """``coverage`` of entities that have their ``n_edges``."""
    joined = mentions.join(entities, "canonical_id").join(graph_documents(edges), "canonical_id", "left")
    n = F.coalesce("documents_in_graph", F.lit(0))
    return joined.select("canonical_id", "canonical_name", F.col("search_term").alias("search_term_used"), F.col("document_count").alias("total_documents_mentioning"), n.alias("documents_in_knowledge_graph"), (n / F.col("document_count")).alias("coverage_ratio"), F.greatest(F.lit(0), F.col("document_count") - n).alias("unanalyzed_count"), F.col("n_edges").alias("connections"))


def coverage_extracted(entities: DataFrame, extracted: DataFrame, edges: DataFrame, every: bool = False) -> DataFrame:
    """Fallback by pre-extracted names (pos, entity_value, document_count): equal lower-case names, the last row of a name counts.

    Of an id's names the one in most documents counts; with ``every`` each name found gives a row.
    """
    known = extracted.where("document_count > 0").groupBy(F.lower("entity_value").alias("form")).agg(F.max_by("document_count", "pos").alias("document_count"))
    names = search_names(entities.where("entity_type = 'person'"), 1)
    counts = names.select("term").distinct().join(known, F.lower("term") == F.col("form")).select("term", "document_count")
    found = names.select("canonical_id", F.col("term").alias("search_term")).distinct().join(counts.withColumnRenamed("term", "search_term"), "search_term") if every else best_search_term(names, counts)
    return _covered(entities.withColumn("n_edges", F.lit(0)), found, edges)


def coverage_any(entities: DataFrame, edges: DataFrame, pages: DataFrame | None, extracted: DataFrame | None, top_n: int = 2000, every: bool = False) -> DataFrame:
    """By the corpus if there is one, or else by extracted names (``every`` as there)."""
    if pages is not None:
        return coverage(entities, mention_counts(entities, edges, pages, top_n), edges)
    if extracted is None:
        raise ValueError("coverage needs pages or extracted names")
    return coverage_extracted(entities, extracted, edges, every)
