"""Schemas of the unified tables and of the source inputs."""

from __future__ import annotations

ENTITIES = "canonical_id string, entity_type string, canonical_name string, aliases array<string>, metadata string, first_seen_date string, last_updated string, notes string"
RESOLUTION_LOG = "source_system string, source_entity_id string, source_entity_name string, canonical_id string, match_method string, match_confidence double, match_details string, resolved_by string, resolved_date string"
RELATIONSHIPS = "relationship_id bigint, source_entity_id string, target_entity_id string, relationship_type string, relationship_subtype string, date_start string, date_end string, weight double, confidence_score double, source_documents array<string>, notes string"
RELATIONSHIP_SOURCES = "id bigint, relationship_id bigint, source_system string, source_relationship_id string, source_relationship_type string, source_evidence string, source_confidence double, evidence_class string, date_added string"
DOCUMENT_IDS = "doc_key string, efta_number string, doj_ogr_id string, source_system string, raw_id string, confidence double"
CONFLICTS = "entity_or_relationship string, record_id string, source_a string, source_b string, field_in_conflict string, value_a string, value_b string, nature_of_conflict string, resolution_status string"
PIPELINE_RUNS = "step_name string, started_at string, completed_at string, status string, records_processed bigint, notes string"
ENTITY_MERGES = "survivor_id string, survivor_name string, absorbed_id string, absorbed_name string, merge_reason string, match_key string, merged_at string"

TABLES = {
    "canonical_entities": ENTITIES,
    "entity_resolution_log": RESOLUTION_LOG,
    "relationships": RELATIONSHIPS,
    "relationship_sources": RELATIONSHIP_SOURCES,
    "document_ids": DOCUMENT_IDS,
    "conflicts": CONFLICTS,
    "pipeline_runs": PIPELINE_RUNS,
    "entity_merges": ENTITY_MERGES,
}

PERSON_REGISTRY = "name string, slug string, aliases array<string>, category string, sources array<string>, search_terms array<string>"
GRAPH_ENTITIES = "id bigint, name string, entity_type string, aliases string, metadata string"
GRAPH_RELATIONSHIPS = "id bigint, source_entity_id bigint, target_entity_id bigint, relationship_type string, weight double, date_first string, date_last string, metadata string"
ANALYSIS = "document_id string, document_number string, page_count int, analysis struct<document_type:string,key_people:array<struct<name:string,role:string>>,key_topics:array<string>,significance:string,summary:string>"
EXTRACTED_NAMES = "names array<struct<entity_value:string,document_count:int,efta_numbers:array<string>>>"
