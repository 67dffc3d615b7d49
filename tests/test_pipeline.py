import json

import pytest
from pyspark.sql import functions as F

from corroba import schemas
from corroba.plans.pipeline import STEPS, Pipeline, Sources
from corroba.sources import readers, sinks
from corroba.streaming.crosswalk import Crosswalk


@pytest.fixture
def files(tmp_path):
    def put(name, value):
        path = tmp_path / name
        path.write_text(json.dumps(value), encoding="utf-8")
        return str(path)

    return put


PERSONS = [{"name": "Ada Quist", "slug": "ada", "aliases": ["A. Quist"], "category": "business"}, {"name": "[REDACTED]", "slug": "r"}, {"name": "Boris Lind", "slug": "boris"}]
ENTITIES = [{"id": 1, "name": "Ada Quist", "aliases": '["Adda Quist"]', "metadata": '{"occupation": "pilot", "person_type": "crew"}'}, {"id": 2, "name": "Cyd Marsh", "metadata": "{}"}, {"id": 3, "name": "Quist Works", "entity_type": "organization", "metadata": "{}"}]
EDGES = [{"id": 1, "source_entity_id": 1, "target_entity_id": 2, "relationship_type": "associated_with", "weight": 2.0, "date_first": "2008-06-01", "metadata": '{"efta": "EFTA00000001"}'}, {"id": 2, "source_entity_id": 1, "target_entity_id": 9, "relationship_type": "x", "weight": 1.0, "metadata": "{}"}]
DEDUPE = {"people": {"A Quist": "Ada Quist", "Dee Novak": "Dee Novak", "Marsh, Cyd": "Cyd Marsh"}, "organizations": {"QW": "Quist Works"}, "locations": {"X": "Xanten"}}
ANALYSES = {"EFTA00000002": {"analysis": {"key_people": [{"name": "A Quist", "role": "owner"}, {"name": "Dee Novak"}, {"name": "Marsh, Cyd"}]}}, "EFTA00000003": [{"analysis": {"key_people": [{"name": "A Quist"}, {"name": "Dee Novak"}]}}]}


def test_readers(spark, files):
    people = readers.person_registry(spark, files("p.json", PERSONS))
    assert [(r.canonical_id, r["name"]) for r in people.orderBy("pos").collect()] == [("PER-00001", "Ada Quist"), ("PER-00002", "Boris Lind")]
    entities = readers.graph_entities(spark, files("e.json", ENTITIES)).orderBy("id").collect()
    assert [(r.entity_type, r.aliases) for r in entities] == [("person", ["Adda Quist"]), ("person", None), ("organization", None)]
    assert readers.dedupe_map(spark, files("d.json", DEDUPE)).count() == 5
    for shape in (ANALYSES, [{"document_id": k, **v} for k, v in ANALYSES.items() if isinstance(v, dict)]):
        rows = readers.document_analyses(spark, files("a.json", shape))
        assert {r.document_id for r in rows.collect()} <= {"EFTA00000002", "EFTA00000003"}
    names = readers.extracted_names(spark, files("n.json", {"names": [{"entity_value": "x", "document_count": 2, "efta_numbers": ["e"]}]}))
    assert [tuple(r) for r in names.collect()] == [(0, "x", 2, ["e"])]


def test_optional_sources(spark, tmp_path, files):
    assert not readers.available(spark, str(tmp_path / "none")) and not readers.available(spark, files("tiny.json", {}))
    assert readers.optional(spark, str(tmp_path / "none"), schemas.DOCUMENT_IDS).count() == 0
    assert readers.csv_rows(spark, str(tmp_path / "none"), ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError, match="none of"):
        readers.either(spark.range(1), "actor", "subject")
    subject = spark.createDataFrame([("a", "met with", "b", 1), (None, "x", "b", 2)], "subject string, action string, object string, doc_id int")
    assert [(r.actor, r.target) for r in readers.triples(subject).collect()] == [("a", "b")]
    assert readers.conform(spark.range(2), "id bigint, evidence_class string").columns == ["id", "evidence_class"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1, 2])], "x string, y array<int>")
    assert sinks.write_csv(rows, str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == [("a", "1; 2")]
    assert not sinks.write_csv(rows.where("false"), str(tmp_path / "d"), always=False)
    top = spark.createDataFrame([("Ada", 3.25, "f")], "canonical_name string, priority_score double, factors string")
    assert "| 1 | Ada | 3.2 | f |" in sinks.markdown_summary(top)


def test_whole_pipeline(spark, tmp_path, files):
    triples = spark.createDataFrame([(i, "Ada Quist", "met with", "Dee Novak", str(i)) for i in range(7)] + [(8, "Quist, Ada", "paid", "Nobody Known", "8")], "id int, actor string, action string, target string, doc_id string")
    aliases = spark.createDataFrame([("Quist, Ada", "Ada Quist", 1)], "original_name string, canonical_name string, hop_distance_from_principal int")
    pages = spark.createDataFrame([(i, f"EFTA{i:08d}", "Here Ada Quist, with Cyd Marsh.") for i in range(4)], "page int, doc string, text string")
    dated = spark.createDataFrame([("2008-06-01",)] * 30 + [(f"20{i:02d}-01-01",) for i in range(10, 20)], "date_range_earliest string")
    sources = Sources(files("p.json", PERSONS), files("e.json", ENTITIES), files("r.json", EDGES), files("d.json", DEDUPE), files("a.json", ANALYSES), aliases, triples, dated, pages)
    pipeline = Pipeline(spark, str(tmp_path / "run"), sources, {"2008-06": "event"})
    assert tuple(pipeline.run()) == STEPS
    entities = {r.canonical_name: r for r in pipeline.store.read("canonical_entities").collect()}
    assert set(entities) == {"Ada Quist", "Boris Lind", "Cyd Marsh", "Quist Works", "Dee Novak", "Xanten"}
    assert {"A. Quist", "Adda Quist"} <= set(entities["Ada Quist"].aliases)
    name = {r.canonical_id: n for n, r in entities.items()}
    edges = {(*sorted((name[r.source_entity_id], name[r.target_entity_id])), r.relationship_type): r for r in pipeline.store.read("relationships").collect()}
    assert edges["Ada Quist", "Cyd Marsh", "associated_with"].weight == 2.0
    assert edges["Ada Quist", "Dee Novak", "co_documented"].weight == 2.0
    assert edges["Ada Quist", "Dee Novak", "associated_with"].weight == 5.0
    systems = {r.source_system for r in pipeline.store.read("relationship_sources").collect()}
    assert systems == {"registry", "documents", "triples", "corpus"}
    told = {n: json.loads(r.metadata) for n, r in entities.items()}
    assert told["Ada Quist"]["category"] == "business" and told["Ada Quist"]["occupation"] == "pilot" and told["Ada Quist"]["observed_roles"] == {"owner": 1}
    assert told["Ada Quist"]["corpus_document_count"] == 4 and told["Dee Novak"]["source_system"] == "documents"
    triple = edges["Ada Quist", "Dee Novak", "associated_with"]
    assert len(triple.source_documents) == 7 and all(d.startswith("RAW-") for d in triple.source_documents)
    evidence = {(r.relationship_id, r.source_system): json.loads(r.source_evidence) for r in pipeline.store.read("relationship_sources").collect()}
    known = evidence[triple.relationship_id, "triples"]
    assert known["document_count"] == 7 and len(known["doc_key_sample"]) == 7 and known["action_counts"] == {"met with": 7}
    assert set(edges["Ada Quist", "Cyd Marsh", "associated_with"].source_documents) >= {"EFTA00000001", "EFTA00000002"}
    log = pipeline.store.read("entity_resolution_log").where("source_system = 'documents'").collect()
    assert all(json.loads(r.match_details)["entity_type_key"] in ("people", "organizations", "locations") for r in log)
    assert {"EFTA00000001", "EFTA00000002", "EFTA00000003"} <= {r.doc_key for r in pipeline.store.read("document_ids").collect()}
    clash = {r.record_id: (r.value_a, r.value_b) for r in pipeline.store.read("conflicts").where("entity_or_relationship = 'entity'").collect()}
    assert next(k for k, n in name.items() if n == "Ada Quist") in clash
    assert "Ada Quist" in pipeline.summary
    assert [r.event for r in spark.read.csv(str(tmp_path / "run/output/temporal_anomalies"), header=True).collect()] == ["event"]
    assert pipeline.store.read("pipeline_runs").count() == len(STEPS)
    report = {r["table"]: r["rows"] for r in pipeline.store.summary().collect()}
    assert report["canonical_entities"] == 6
    orphans = pipeline.store.read("relationships").join(pipeline.store.read("canonical_entities"), F.col("source_entity_id") == F.col("canonical_id"), "left_anti")
    assert orphans.count() == 0


def test_modes(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path / "run"), Sources())
    done = pipeline.run(skip_triples=True)
    assert "ingest_triples" not in done and len(done) == len(STEPS) - 1
    assert pipeline.run("analysis-only")[0] == "corroboration"
    with pytest.raises(KeyError):
        pipeline.run("other")


def test_streaming_crosswalk(spark, tmp_path):
    refs = str(tmp_path / "refs")
    schema = "raw string, seq bigint"
    for k, rows in enumerate(([("EFTA000001 DOJ OGR 7", 1), ("x", 2)], [("DOJ-OGR-7", 3), ("x", 4)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(refs)
        walk = Crosswalk(spark, str(tmp_path / "walk"))  # a new object for each batch: the state is in the folder
        query = walk.start(spark.readStream.schema(schema).parquet(refs), str(tmp_path / "check"))
        query.awaitTermination(60)
        assert walk.batch == k
    got = {r.doc_key: (r.efta, r.ogr, r.seq) for r in walk.read().collect()}
    assert got["EFTA000001"] == ("EFTA000001", "DOJ-OGR-00000007", 3) and len(got) == 2
    again = Crosswalk(spark, str(tmp_path / "walk"))
    again.upsert(spark.createDataFrame([("DOJ-OGR-7", 3), ("x", 4)], schema), 1)  # delivered once more
    assert {r.doc_key: (r.efta, r.ogr, r.seq) for r in again.read().collect()} == got and again.batch == 1


def test_store_goes_on_where_it_was(spark, tmp_path):
    first = sinks.Store(spark, str(tmp_path / "s")).create()
    first.log_run("a", "completed", 1)
    first.log_run("b", "completed", 2)
    first.write("conflicts", spark.createDataFrame([("x",)], "record_id string"))
    second = sinks.Store(spark, str(tmp_path / "s"))
    assert [r.step_name for r in second.read("pipeline_runs").orderBy("started_at").collect()] == ["a", "b"]
    assert second.version == first.version and second.read("conflicts").count() == 1
    assert second.append("conflicts", spark.createDataFrame([("y",)], "record_id string")).count() == 2
