"""The reconciliation pipeline: thirteen steps over versioned tables, in one session.

Every step reads the last version of the tables it needs and writes new ones, so a failed step can be run
again and repeated runs give the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import docids, names
from ..operators import cleanup, conflicts, corpus, evidence, graph, prioritize, relationships, resolve, temporal, validate
from ..sources import readers, sinks

PERSON_FIELDS = "occupation string, legal_status string, person_type string, ds10_mention_count bigint, public_figure boolean"
STEPS = ("create", "ingest_registry", "ingest_documents", "ingest_triples", "validate", "merge", "corpus", "corroboration", "gaps", "coverage", "temporal", "contradictions", "prioritize")
ANALYSIS = STEPS[STEPS.index("corroboration") :]


@dataclass
class Sources:
    """Where the inputs lie; None for those that are missing."""

    persons: str | None = None
    graph_entities: str | None = None
    graph_relationships: str | None = None
    dedupe: str | None = None
    analyses: str | None = None
    aliases: DataFrame | None = None
    triples: DataFrame | None = None
    dated_documents: DataFrame | None = None
    pages: DataFrame | None = None
    extracted: DataFrame | None = None


@dataclass
class Pipeline:
    spark: SparkSession
    root: str
    sources: Sources
    events: dict[str, str] = field(default_factory=dict)
    dry_run: bool = False

    def __post_init__(self):
        self.store = sinks.Store(self.spark, f"{self.root}/tables")
        self.scratch = 0

    # ---- helpers ----

    def kept(self, df: DataFrame) -> DataFrame:
        """Written beside the tables and read again."""
        self.scratch += 1
        path = f"{self.root}/scratch/{self.scratch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, name: str, df: DataFrame, always: bool = True) -> DataFrame:
        df = self.kept(df)
        sinks.write_csv(df, f"{self.root}/output/{name}", always)
        return df

    def run(self, mode: str = "full", skip_triples: bool = False) -> list[str]:
        """Runs a mode (full, analysis-only, cleanup-only); returns the steps done."""
        steps = {"full": STEPS, "analysis-only": ANALYSIS, "cleanup-only": ("merge", *ANALYSIS)}[mode]
        done = []
        for step in steps:
            if step == "ingest_triples" and skip_triples:
                continue
            started = sinks.now_iso()
            n = getattr(self, step)()
            self.store.log_run(step, "completed", n, None, started)
            done.append(step)
        return done

    def _taken(self, prefix: str) -> int:
        ids = self.store.read("canonical_entities").where(F.col("canonical_id").startswith(f"{prefix}-"))
        return ids.agg(F.max(F.substring_index("canonical_id", "-", -1).cast("bigint"))).first()[0] or 0

    def _add_entities(self, rows: DataFrame) -> None:
        self.store.append("canonical_entities", rows)

    def _add_edges(self, rows: DataFrame, system: str, source_type: str, kind: str) -> int:
        """Appends edges with new ids, and a provenance row for each."""
        taken = self.store.read("relationships").agg(F.max("relationship_id")).first()[0] or 0
        order = ["source_entity_id", "target_entity_id", "relationship_type"]
        new = self.kept(resolve.numbered(rows, order, taken, "relationship_id", self.kept))
        self.store.append("relationships", new)
        evidence = F.col("source_evidence") if "source_evidence" in new.columns else F.to_json(F.struct(F.col("source_documents").alias("doc_keys")))
        told = F.col("source_relationship_type") if "source_relationship_type" in new.columns else F.lit(source_type) if source_type else F.col("relationship_type")
        self._add_sources(new.select("relationship_id", F.lit(system).alias("source_system"), told.alias("source_relationship_type"), evidence.alias("source_evidence"), F.col("confidence_score").alias("source_confidence"), F.lit(kind).alias("evidence_class")))
        return new.count()

    def _add_sources(self, rows: DataFrame) -> None:
        taken = self.store.read("relationship_sources").agg(F.max("id")).first()[0] or 0
        self.store.append("relationship_sources", resolve.numbered(rows, ["relationship_id", "source_system"], taken, "id", self.kept))

    def _add_documents(self, keyed: DataFrame, system: str, confidence: float) -> None:
        """Upserts references (doc_key, efta, ogr, raw_id) into the documents' table."""
        new = keyed.where("doc_key is not null").select("doc_key", F.col("efta").alias("efta_number"), F.col("ogr").alias("doj_ogr_id"), F.lit(system).alias("source_system"), "raw_id", F.lit(confidence).alias("confidence"), F.lit(1).alias("seq")).distinct()
        known = self.store.read("document_ids").withColumn("seq", F.lit(0))
        self.store.write("document_ids", docids.upsert(known.unionByName(new)))

    def _update_metadata(self, added: DataFrame, fill: bool = False) -> None:
        self.store.write("canonical_entities", cleanup.with_metadata(self.store.read("canonical_entities"), added, fill))

    def _add_log(self, rows: DataFrame, system: str) -> None:
        self.store.append("entity_resolution_log", rows.withColumn("source_system", F.lit(system)).withColumn("resolved_by", F.lit("pipeline")))

    def _resolve(self, named: DataFrame, kind: str | None, system: str, new_kind: str) -> DataFrame:
        """Names (name, variants, pos) resolved in order; new entities and log rows are appended. (name, canonical_id).

        JSON columns, if there are any: ``metadata`` of new entities, ``known`` fields that matched ones lack, ``details`` of the log.
        """
        named = named.withColumns({c: F.lit(None).cast("string") for c in ("metadata", "known", "details") if c not in named.columns})
        named = named.groupBy("name").agg(F.min_by(F.struct("pos", "variants", "metadata", "known", "details"), "pos").alias("r")).select("name", "r.*")
        prefix = config.ID_PREFIXES.get(new_kind, "ENT")
        entities = self.store.read("canonical_entities")
        registry = (entities if kind is None else entities.where(F.col("entity_type") == kind)).select("canonical_id", "canonical_name", "aliases")
        registry = resolve.numbered(registry, ["canonical_id"], 0, "seq", self.kept).withColumn("seq", F.col("seq") - 10**9)  # before all probes
        probes = resolve.numbered(named, ["pos", "name"], self._taken(prefix), "key", self.kept).select("key", "name", "variants", "metadata", "known", "details")
        probes = self.kept(probes)
        found, _ = resolve.resolve_in_order(probes, registry, self.kept, prefix)
        found = self.kept(found.join(probes.select("key", "variants", "metadata", "known", "details"), "key"))
        self._add_entities(found.where("match_method = 'new_entity'").select("canonical_id", F.lit(new_kind).alias("entity_type"), F.col("name").alias("canonical_name"), F.col("variants").alias("aliases"), F.coalesce("metadata", F.lit("{}")).alias("metadata")))
        matched = found.where("match_method in ('exact', 'alias', 'fuzzy')")
        fields = matched.where("known is not null").groupBy("canonical_id").agg(F.min_by("known", "key").alias("fields"))
        if fields.head(1):
            self._update_metadata(self.kept(fields), fill=True)
        added = matched.select("canonical_id", "key", F.explode(F.concat(F.array("name"), F.col("variants"))).alias("alias")).select("canonical_id", F.col("key").alias("pos"), "alias")
        self.store.write("canonical_entities", resolve.merge_aliases(self.store.read("canonical_entities"), added))
        self._add_log(found.where("canonical_id is not null").select(F.col("key").cast("string").alias("source_entity_id"), F.col("name").alias("source_entity_name"), "canonical_id", "match_method", "match_confidence", F.col("details").alias("match_details")), system)
        return found.where("canonical_id is not null").select("name", "variants", "canonical_id")

    # ---- steps ----

    def create(self) -> int:
        self.store.create()
        return 0

    def ingest_registry(self) -> int:
        s = self.sources
        if s.persons:
            rows = self.kept(readers.person_registry(self.spark, s.persons))
            meta = F.to_json(F.struct(F.coalesce("category", F.lit("other")).alias("category"), "slug", "sources", "search_terms"))
            self._add_entities(rows.select("canonical_id", F.lit("person").alias("entity_type"), F.col("name").alias("canonical_name"), "aliases", meta.alias("metadata")))
            self._add_log(rows.select(F.col("slug").alias("source_entity_id"), F.col("name").alias("source_entity_name"), "canonical_id", F.lit("base_registry").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.to_json(F.struct("category")).alias("match_details")), "registry")
        if not s.graph_entities:
            return 0
        rows = self.kept(readers.graph_entities(self.spark, s.graph_entities).where(~names.is_redaction_marker(F.col("name"))))
        none = F.array().cast("array<string>")
        ids = None
        for kind in [r.entity_type for r in rows.select("entity_type").distinct().orderBy("entity_type").collect()]:  # a short vocabulary
            part = rows.where(F.col("entity_type") == kind)
            told = F.from_json("metadata", PERSON_FIELDS)
            of_person = F.to_json(told)
            metadata = F.to_json(F.struct(F.coalesce(told["person_type"], F.lit("other")).alias("category"), *(told[f].alias(f) for f in ("occupation", "legal_status", "person_type", "ds10_mention_count", "public_figure")))) if kind == "person" else F.coalesce("metadata", F.lit("{}"))
            details = F.to_json(F.struct(F.lit("graph_entities").alias("source"), F.lit(kind).alias("entity_type"), "id"))
            part = part.withColumns({"fresh": metadata, "known": of_person if kind == "person" else F.lit(None).cast("string"), "details": details})
            found = self._resolve(part.select("name", F.coalesce("aliases", none).alias("variants"), "pos", F.col("fresh").alias("metadata"), "known", "details"), kind if kind == "person" else "none", "registry", kind)
            one = part.join(found.select("name", "canonical_id").distinct(), "name").select("id", "canonical_id")
            ids = one if ids is None else ids.unionByName(one)
        if s.graph_relationships:
            edges, _ = relationships.typed_edges(readers.graph_relationships(self.spark, s.graph_relationships), self.kept(ids))
            edges = self.kept(edges)
            self._add_documents(docids.canonicalize(edges.select(F.explode("source_documents").alias("raw")), ["raw"]), "registry", 0.7)
            return self._add_edges(edges, "registry", "", "curated")
        return rows.count()

    def ingest_documents(self) -> int:
        s = self.sources
        if not s.dedupe:
            return 0
        known = self.kept(readers.dedupe_map(self.spark, s.dedupe))
        people = None
        for kind, new_kind in (("people", "person"), ("organizations", "organization"), ("locations", "location")):
            named = known.where(F.col("kind") == kind).groupBy(F.col("canonical").alias("name")).agg(F.sort_array(F.collect_set("variant")).alias("variants"))
            named = named.where(~names.is_redaction_marker(F.col("name")) & ~names.is_noise_name(F.col("name")))
            details = F.to_json(F.struct(F.lit("dedupe").alias("source"), F.lit(kind).alias("entity_type_key"), F.size("variants").alias("variant_count")))
            named = named.withColumns({"pos": F.lit(0), "metadata": F.lit('{"source_system": "documents"}'), "details": details})
            found = self._resolve(named, new_kind, "documents", new_kind)
            if kind == "people":
                people = found.select(F.explode(F.array_union(F.col("variants"), F.array("name"))).alias("name"), "canonical_id").groupBy("name").agg(F.min("canonical_id").alias("canonical_id"))
        if not s.analyses:
            return known.count()
        keyed = docids.canonicalize(readers.key_people(readers.document_analyses(self.spark, s.analyses)), ["document_id", "document_number"])
        keyed = self.kept(keyed)
        self._add_documents(keyed, "documents", 0.8)
        mentions = self.kept(keyed.where(~names.is_redaction_marker(F.col("name"))).join(people, "name").select("doc_key", "pos", "canonical_id", "role"))
        roles = relationships.role_counts(mentions)
        self._update_metadata(self.kept(roles.select("canonical_id", F.to_json(F.struct("observed_roles")).alias("fields"))))
        pairs = self.kept(relationships.cooccurrence_edges(mentions))
        every = self.kept(relationships.first_documents(relationships.cooccurrence_pairs(mentions), ["a", "b"]).select("a", "b", "doc_keys"))
        new, grown = relationships.apply_cooccurrence(pairs, self.store.read("relationships"))
        grown = self.kept(grown)
        edges = self.store.read("relationships")
        old = self.kept(relationships.against_existing(pairs, edges).where("relationship_id is not null"))
        edges = edges.join(grown, "relationship_id", "left").withColumn("weight", F.col("weight") + F.coalesce("added", F.lit(0))).drop("added")
        self.store.write("relationships", relationships.append_documents(edges, old.join(every, ["a", "b"]).select("relationship_id", "doc_keys")))
        self._add_sources(old.select("relationship_id", F.lit("documents").alias("source_system"), F.lit("co_documented").alias("source_relationship_type"), F.to_json(F.struct("document_count", "doc_key_sample")).alias("source_evidence"), F.lit(config.EDGE_CONFIDENCE["documents"]).alias("source_confidence"), F.lit("cooccurrence").alias("evidence_class")))
        told = F.to_json(F.struct("document_count", "doc_key_sample")).alias("source_evidence")
        docs = pairs.join(every, ["a", "b"]).select(F.col("a").alias("source_entity_id"), F.col("b").alias("target_entity_id"), F.col("doc_keys").alias("source_documents"), told)
        return self._add_edges(new.join(docs, ["source_entity_id", "target_entity_id"]), "documents", "co_documented", "cooccurrence")

    def ingest_triples(self) -> int:
        s = self.sources
        if s.triples is None:
            return 0
        if s.aliases is not None:
            named = s.aliases.where("canonical_name is not null").groupBy(F.col("canonical_name").alias("name")).agg(F.sort_array(F.collect_set("original_name")).alias("variants"))
            named = named.where(~names.is_redaction_marker(F.col("name")) & ~names.is_noise_name(F.col("name")))
            self._resolve(named.withColumn("pos", F.lit(0)), None, "triples", "person")
        index = resolve.name_index(resolve.numbered(self.store.read("canonical_entities").select("canonical_id", "canonical_name", "aliases"), ["canonical_id"], 0, "seq"))
        keyed = docids.canonicalize(readers.triples(s.triples), ["doc_id"])
        rows = self.kept(relationships.triple_rows(keyed, index.select("form", "canonical_id"), s.aliases))
        self._add_documents(rows, "triples", 0.6)
        pairs = relationships.edges_of_triples(rows).drop("n_triples").join(relationships.triple_evidence(rows), relationships.KEYS)
        known = self.kept(graph.existing_relationship(pairs, self.store.read("relationships")))
        edges = self.store.read("relationships")
        more = known.where("relationship_id is not null").select("relationship_id", (F.col("weight") - 1).alias("added"))
        edges = edges.join(more, "relationship_id", "left").withColumn("weight", F.col("weight") + F.coalesce("added", F.lit(0.0))).drop("added")
        self.store.write("relationships", relationships.append_documents(edges, known.where("relationship_id is not null").select("relationship_id", "doc_keys")))
        self._add_sources(known.where("relationship_id is not null").select("relationship_id", F.lit("triples").alias("source_system"), F.col("relationship_subtype").alias("source_relationship_type"), "source_evidence", F.lit(config.EDGE_CONFIDENCE["triples"]).alias("source_confidence"), F.lit("rdf").alias("evidence_class")))
        new = known.where("relationship_id is null").select(F.col("a").alias("source_entity_id"), F.col("b").alias("target_entity_id"), "relationship_type", "relationship_subtype", "weight", F.lit(config.EDGE_CONFIDENCE["triples"]).alias("confidence_score"), F.col("doc_keys").alias("source_documents"), "source_evidence", "notes", F.col("relationship_subtype").alias("source_relationship_type"))
        return self._add_edges(new, "triples", "", "rdf")

    def validate(self) -> int:
        report = validate.report(self.store.tables())
        self.result("fuzzy_matches_review", report["fuzzy_review"])
        return report["orphans"].count()

    def merge(self) -> int:
        tables = self.store.tables()
        noise = self.kept(cleanup.noise_entities(tables["canonical_entities"], tables["relationships"]))
        tables["canonical_entities"] = cleanup.flag_entities(tables["canonical_entities"], noise.where("action = 'flag'"))
        gone = noise.where("action = 'delete'")
        tables = cleanup.delete_entities(tables, gone)
        candidates = self.kept(cleanup.merge_candidates(tables["canonical_entities"], tables["relationships"]))
        if self.dry_run:
            self.result("merge_candidates", candidates)
            return candidates.count()
        merges = self.kept(cleanup.applied_merges(self.spark, candidates, self.kept))
        audit = candidates.join(merges, ["survivor_id", "absorbed_id"]).select("survivor_id", "absorbed_id", F.col("reason").alias("merge_reason"), "match_key", F.lit(sinks.now_iso()).alias("merged_at"))
        deleted = gone.select(F.lit("NOISE_DELETED").alias("survivor_id"), F.col("canonical_id").alias("absorbed_id"), F.col("canonical_name").alias("absorbed_name"), F.col("reason").alias("merge_reason"), F.lit(sinks.now_iso()).alias("merged_at"))
        tables = cleanup.apply_merges(tables, merges)
        tables["canonical_entities"] = cleanup.apply_name_cleanups(tables["canonical_entities"])
        for name in ("canonical_entities", "relationships", "relationship_sources", "entity_resolution_log"):
            self.store.write(name, tables[name])
        self.store.append("entity_merges", audit.unionByName(deleted, allowMissingColumns=True))
        return merges.count()

    def corpus(self) -> int:
        pages = self.sources.pages
        if pages is None:
            return 0
        entities, edges = self.store.read("canonical_entities"), self.store.read("relationships")
        self.mentions = self.kept(corpus.mention_counts(entities, edges, pages))
        fields = F.to_json(F.struct(F.col("document_count").alias("corpus_document_count"), F.col("search_term").alias("corpus_search_term")))
        self._update_metadata(self.mentions.select("canonical_id", fields.alias("fields")))
        known = self.kept(corpus.corroborate(entities, edges, self.store.read("relationship_sources"), pages))
        self._add_sources(known.withColumn("source_evidence", F.to_json(F.struct("document_count", F.col("sample").alias("efta_sample")))).drop("document_count", "sample"))
        found = self.kept(corpus.discover(entities, self.mentions, edges, pages))
        return self._add_edges(found, "corpus", "co_occurrence", "corpus_cooccurrence")

    def corroboration(self) -> int:
        rows = self.kept(evidence.corroboration(self.store.read("relationships"), self.store.read("canonical_entities"), self.store.read("relationship_sources")))
        self.result("corroboration_rankings", evidence.ranked(rows))
        self.weak = self.result("weakly_corroborated", evidence.weak(rows))
        return rows.count()

    def gaps(self) -> int:
        entities = self.store.read("canonical_entities")
        nodes, edges = graph.build_graph(entities, self.store.read("relationships"), 5, names.is_graph_noise(F.col("canonical_name")), cleanup.excluded_ids(entities))
        edges, nodes = self.kept(edges), self.kept(nodes)
        name = lambda c, out: nodes.select(F.col("canonical_id").alias(c), F.col("canonical_name").alias(out))
        found = graph.common_neighbour_gaps(edges).join(name("a", "entity_a"), "a").join(name("b", "entity_b"), "b")
        self.gap_rows = self.result("connection_gaps", found, False)
        bridges = graph.community_bridges(edges, graph.communities(edges, materialise=self.kept)).join(name("node", "entity"), "node")
        self.bridge_rows = self.result("community_bridges", bridges, False)
        return self.gap_rows.count()

    def coverage(self) -> int:
        s = self.sources
        if s.pages is None and s.extracted is None:
            self.coverage_rows = None
            return 0
        rows = corpus.coverage_any(self.store.read("canonical_entities").where("entity_type = 'person'"), self.store.read("relationships"), s.pages, s.extracted)
        self.coverage_rows = self.result("document_coverage", rows.orderBy(F.desc("unanalyzed_count"), "canonical_id"))
        return self.coverage_rows.count()

    def temporal(self) -> int:
        events = temporal.events_table(self.spark, self.events)
        rows = temporal.relationship_timeline(self.store.read("relationships"), self.store.read("canonical_entities"), events)
        rows = self.result("relationship_timeline", rows.orderBy("date_start", "relationship_id"), False)
        if self.sources.dated_documents is not None:
            months = self.sources.dated_documents.select(temporal.month(F.col("date_range_earliest")).alias("month"))
            self.result("temporal_anomalies", temporal.volume_anomalies(months, "month", events).orderBy("period"), False)
        return rows.count()

    def contradictions(self) -> int:
        entities, edges, log = (self.store.read(t) for t in ("canonical_entities", "relationships", "entity_resolution_log"))
        name = lambda c, out: entities.select(F.col("canonical_id").alias(c), F.col("canonical_name").alias(out))
        types = conflicts.relationship_types(edges, self.store.read("relationship_sources")).join(edges.select("relationship_id", "source_entity_id", "target_entity_id"), "relationship_id")
        types = types.join(name("source_entity_id", "entity_a"), "source_entity_id").join(name("target_entity_id", "entity_b"), "target_entity_id")
        told = F.coalesce(F.get_json_object("match_details", "$.category"), F.get_json_object("match_details", "$.entity_type_key"))
        categories = log.join(entities.where("entity_type = 'person'").select("canonical_id"), "canonical_id", "left_semi").select("canonical_id", "source_system", told.alias("category"), F.xxhash64("source_entity_id").alias("seq"))
        roles = entities.select("canonical_id", F.posexplode(F.from_json(F.get_json_object("metadata", "$.observed_roles"), "map<string,bigint>")).alias("pos", "role", "n"))
        kinds = conflicts.entity_categories(categories, roles).join(name("canonical_id", "entity_a"), "canonical_id").withColumn("entity_b", F.lit(""))
        shape = ["record_type", "record_id", "entity_a", "entity_b", "source_a", "source_b", "field", "value_a", "value_b", "severity"]
        rows = types.withColumn("record_type", F.lit("relationship")).withColumn("record_id", F.col("relationship_id").cast("string")).select(*shape).unionByName(kinds.withColumn("record_type", F.lit("entity")).withColumn("record_id", F.col("canonical_id")).select(*shape))
        self.conflict_rows = self.result("contradictions", conflicts.ordered(rows))
        self.store.write("conflicts", self.conflict_rows.select(F.col("record_type").alias("entity_or_relationship"), "record_id", "source_a", "source_b", F.col("field").alias("field_in_conflict"), "value_a", "value_b", F.col("severity").alias("nature_of_conflict"), F.lit("unresolved").alias("resolution_status")))
        return self.conflict_rows.count()

    def prioritize(self) -> int:
        entities, edges = self.store.read("canonical_entities"), self.store.read("relationships")
        factors = [prioritize.prominence_factor(entities, edges, cleanup.excluded_ids(entities)), prioritize.weak_factor(self.weak), prioritize.gap_factor(self.gap_rows), prioritize.bridge_factor(self.bridge_rows), prioritize.contradiction_factor(self.conflict_rows)]
        if self.coverage_rows is not None:
            factors.append(prioritize.coverage_factor(self.coverage_rows))
        mentions = getattr(self, "mentions", None)
        if mentions is not None:
            factors.append(prioritize.corpus_factor(graph.with_incident_edges(mentions.join(entities.select("canonical_id", "canonical_name"), "canonical_id"), edges)))
        rows = self.result("research_priorities", prioritize.priorities(factors).orderBy(F.desc("priority_score"), "canonical_name"))
        self.summary = sinks.markdown_summary(rows)
        return rows.count()
