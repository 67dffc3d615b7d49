import random

import pytest
from pyspark.sql import functions as F

from corroba.operators import cleanup, conflicts, corpus, evidence, graph, prioritize, relationships, resolve, temporal, validate
from corroba.functions import similarity

EDGE = "relationship_id long, source_entity_id string, target_entity_id string, relationship_type string, weight double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def edges(spark):
    return spark.createDataFrame([(1, "a", "b", "x", 1.0), (2, "b", "a", "x", None), (3, "a", "a", "x", 1.0), (4, "b", "c", "y", 2.0)], EDGE)


def test_prominence_counts_self_loops_twice_and_incident_edges_once(edges):
    assert rows(graph.prominence(edges)) == [("a", 4), ("b", 3), ("c", 1)]
    assert rows(graph.incident_edges(edges)) == [("a", 3), ("b", 3), ("c", 1)]


def test_simple_graph_and_undirected(edges):
    assert rows(graph.simple_graph(edges)) == [("a", "b", 2.0), ("b", "c", 2.0)]
    assert sorted((r.node, r.neighbour) for r in graph.undirected(edges).collect()) == [("a", "a"), ("a", "b"), ("a", "b"), ("b", "a"), ("b", "a"), ("b", "c"), ("c", "b")]


def test_existing_relationship_in_either_direction(spark, edges):
    pairs = spark.createDataFrame([("a", "b", "x"), ("b", "c", "x")], "a string, b string, relationship_type string")
    assert [tuple(r) for r in graph.existing_relationship(pairs, edges).orderBy("a").collect()] == [("a", "b", "x", 1), ("b", "c", "x", None)]


def test_gaps_and_bridges(spark):
    g = spark.createDataFrame([(x, h, 1.0) for x in "ab" for h in "pqr"] + [("p", "z", 1.0)], "a string, b string, weight double")
    found = graph.common_neighbour_gaps(g).collect()
    assert [(r.a, r.b, r.common_neighbours, r.priority_score) for r in found] == [("a", "b", 3, 18)]
    labels = spark.createDataFrame([("p", 1), ("q", 1), ("r", 2), ("a", 1), ("b", 2), ("z", 3)], "node string, community int")
    assert rows(graph.community_bridges(g, labels).select("node", "communities_connected", "bridge_score")) == [("a", 2, 6), ("b", 2, 6), ("p", 3, 9), ("q", 2, 4), ("r", 2, 4)]


def test_communities_find_two_cliques(spark, written):
    clique = lambda s: [(x, y, 5.0) for i, x in enumerate(s) for y in s[i + 1 :]]
    g = spark.createDataFrame([*clique("abcde"), *clique("vwxyz"), ("a", "v", 1.0)], "a string, b string, weight double")
    labels = {r.node: r.community for r in graph.communities(g, materialise=written).collect()}
    assert len({labels[x] for x in "abcde"}) == 1 and len({labels[x] for x in "vwxyz"}) == 1 and labels["a"] != labels["z"]


def test_cooccurrence_counts_repeats_and_drops_self_pairs(spark):
    m = spark.createDataFrame([("d1", 0, "x"), ("d1", 1, "y"), ("d1", 2, "x"), ("d2", 0, "x")], "doc_key string, pos int, canonical_id string")
    assert [tuple(r) for r in relationships.cooccurrence_edges(m).collect()] == [("x", "y", 2, 1, ["d1"])]


def test_existing_cooccurrence_grows_but_for_the_first_hit(spark, edges):
    pairs = spark.createDataFrame([("a", "b", 3), ("c", "d", 2), ("e", "f", 4)], "a string, b string, weight long")
    known = edges.unionByName(spark.createDataFrame([(9, "d", "c", "co_documented", 1.0)], EDGE))
    new, grown = relationships.apply_cooccurrence(pairs, known)
    assert rows(new.select("source_entity_id", "target_entity_id", "weight")) == [("e", "f", 4.0)]
    assert rows(grown) == [(9, 1)]


def test_triples_are_capped_and_undirected(spark):
    t = spark.createDataFrame([(i, "Ann Lee", "met with", "Bo Orr") for i in range(7)] + [(7, "Bo Orr", "met with", "Ann Lee"), (8, "(b)(6)", "paid", "Bo Orr"), (9, "Al", "paid", "Al")], "seq int, actor string, action string, target string")
    ids = spark.createDataFrame([("ann lee", "P1"), ("bo orr", "P2"), ("al", "P3")], "form string, canonical_id string")
    assert rows(relationships.triple_edges(t, ids).select("a", "b", "relationship_type", "weight", "n_triples")) == [("P1", "P2", "associated_with", 5.0, 8)]


def test_top_actions_break_ties_by_first_appearance(spark):
    t = spark.createDataFrame([(1, "k", "z"), (2, "k", "a"), (3, "k", "m"), (4, "k", "m")], "seq int, key string, action string")
    assert [r.action for r in relationships.top_actions(t, ["key"], 2).orderBy("rank").collect()] == ["m", "z"]
    assert relationships.action_counts(t, ["key"]).first().action_counts == {"m": 2, "z": 1, "a": 1}


def test_role_counts_add_up(spark):
    m = spark.createDataFrame([("p", "pilot"), ("p", "pilot"), ("p", None), ("q", "")], "canonical_id string, role string")
    old = spark.createDataFrame([("p", {"pilot": 1, "owner": 2})], "canonical_id string, observed_roles map<string,bigint>")
    assert [(r.canonical_id, r.observed_roles) for r in relationships.role_counts(m, old).collect()] == [("p", {"owner": 2, "pilot": 3})]


def test_typed_edges_report_unmapped_ends(spark):
    raw = spark.createDataFrame([(1, 10, 11, "t", 2.0, "2001", None, '{"efta": "EFTA000001", "notes": "n"}'), (2, 10, 99, "t", 1.0, None, None, None)], "id long, source_entity_id long, target_entity_id long, relationship_type string, weight double, date_first string, date_last string, metadata string")
    ids = spark.createDataFrame([(10, "P"), (11, "Q")], "id long, canonical_id string")
    known, lost = relationships.typed_edges(raw, ids)
    assert [(r.source_entity_id, r.target_entity_id, r.source_documents, r.notes) for r in known.collect()] == [("P", "Q", ["EFTA000001"], "n")]
    assert [r.id for r in lost.collect()] == [2]


def test_corroboration_and_weak(spark):
    e = spark.createDataFrame([(i, "a", f"n{i}", "x", 1.0, ["EFTA000001"]) for i in range(21)], EDGE + ", source_documents array<string>")
    entities = spark.createDataFrame([("a", "person", "A"), *((f"n{i}", "person", f"N{i}") for i in range(21))], "canonical_id string, entity_type string, canonical_name string")
    s = spark.createDataFrame([(0, "registry", None, '{"d": "EFTA000002"}'), (0, "triples", None, None), (1, "documents", None, None), (2, "triples", None, "{}")], "relationship_id long, source_system string, evidence_class string, source_evidence string")
    records = {r.relationship_id: r for r in evidence.corroboration(e, entities, s).collect()}
    assert (records[0].num_sources, records[0].evidence_points, records[0].num_documents) == (2, 2.5, 2)
    assert all(0 <= r.corroboration_score <= 1 for r in records.values())
    assert [r.relationship_id for r in evidence.weak(evidence.corroboration(e, entities, s)).collect()] == [2]


NAMES = ["Ada Quist", "Ada Quiste", "Boris Lind", "Boris B. Lind", "Cyd Marsh", "Cyd Marsch", "Dee Novak", "Elias Orr", "Elias Orre", "Fay Pike", "Quist, Ada", "Gus Reyes", "Victim #2", "Jane Doe #1", "", "Boriss Lindd", "Marsh Cyd"]


def sequential(probes, cutoff=90.0):
    """The order-dependent model, in plain Python."""
    import re

    def norm(n):
        n = n.strip()
        m = re.match(r"^([^,]*[^,\s])\s*,\s*(\S.*?)\s*$", n)
        n = f"{m[2]} {m[1]}" if m else n
        return " ".join(n.split())

    def short(n):
        p = norm(n).split()
        return f"{p[0]} {p[-1]}" if len(p) > 2 else norm(n)

    lookup, every, main, out = {}, [], {}, {}
    for key, name, variants in probes:
        if not name.strip():
            out[key] = (None, "no_match")
            continue
        if re.search("victim", name, re.I):
            out[key] = (None, "noise")
            continue
        hit = None
        for form in (name.strip().lower(), norm(name).lower(), short(name).lower()):
            if form in lookup:
                hit = (lookup[form], "exact" if form == main[lookup[form]] else "alias")
                break
        if hit is None and not re.search(r"(?:Jane|John)\s+Doe\s*[#]?\d", name, re.I):
            a, best = " ".join(sorted(norm(name).split())), None
            for n, c in every:
                score = similarity.indel_ratio(a, " ".join(sorted(norm(n).split())))
                if score >= cutoff and (best is None or score > best[0]):
                    best = (score, c)
            if best and not (len(norm(name)) <= 10 and best[0] < 95):
                hit = (best[1], "fuzzy")
        if hit is None:
            hit = (f"PER-{key:05d}", "new_entity")
            main[hit[0]] = name.lower()
        for n in [name, *variants]:
            every.append((n, hit[0]))
            for form in (n.strip().lower(), norm(n).lower(), short(n).lower()):
                if form:
                    lookup[form] = hit[0]
        out[key] = hit
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_give_the_sequential_result(spark, written, seed):
    r = random.Random(seed)
    probes = [(i + 1, r.choice(NAMES), r.sample(NAMES[:6], r.randint(0, 1))) for i in range(25)]
    frame = spark.createDataFrame(probes, "key long, name string, variants array<string>")
    none = spark.createDataFrame([], "canonical_id string, canonical_name string, aliases array<string>, seq long")
    got, founded = resolve.resolve_in_order(frame, none, written)
    assert {x.key: (x.canonical_id, x.match_method) for x in got.collect()} == sequential(probes)
    assert founded.count() == sum(m == "new_entity" for _, m in sequential(probes).values())


def test_similar_candidates_miss_nothing(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcd ") for _ in range(r.randint(1, 18))).strip() or "a" for _ in range(60)]
    near = [w[:k] + r.choice("abcd") + w[k:] for w in words for k in [r.randint(0, len(w))]]
    left = spark.createDataFrame(list(enumerate(near)), "key int, a string")
    right = spark.createDataFrame(list(enumerate(words)), "id int, b string")
    got = {(x.key, x.id) for x in resolve.similar_candidates(left, right, 90.0).collect()}
    assert {(i, j) for i, a in enumerate(near) for j, b in enumerate(words) if similarity.indel_ratio(a, b) >= 90} <= got


def test_resolve_against_registry(spark):
    registry = spark.createDataFrame([("P1", "Ada Quist", ["A. Quist"], 1), ("P2", "Boris Lindqvist", None, 2)], "canonical_id string, canonical_name string, aliases array<string>, seq int")
    probes = spark.createDataFrame(list(enumerate(["ada quist", "A. Quist", "Boris Lindqvistt", "Victim #1", " ", "Detective 3", "Ada Quish"])), "key int, name string")
    got = {r.key: (r.canonical_id, r.match_method) for r in resolve.resolve(probes, registry).collect()}
    assert got == {0: ("P1", "exact"), 1: ("P1", "alias"), 2: ("P2", "fuzzy"), 3: (None, "noise"), 4: (None, "no_match"), 5: (None, "no_match"), 6: (None, "no_match")}


def test_merge_aliases_and_ids(spark):
    e = spark.createDataFrame([("P1", "Ada", ["x"])], "canonical_id string, canonical_name string, aliases array<string>")
    more = spark.createDataFrame([("P1", "ADA", 1), ("P1", "X", 2), ("P1", "y", 3), ("P1", "Y", 4)], "canonical_id string, alias string, pos int")
    assert resolve.merge_aliases(e, more).first().aliases == ["x", "y"]
    ids = resolve.next_ids(spark.range(1, 30), ["id"], 99_990, "PER")
    assert [r.canonical_id for r in ids.orderBy("id").collect()] == [f"PER-{i:05d}" for i in range(99_991, 100_020)]


PERSON = "canonical_id string, entity_type string, canonical_name string, aliases array<string>, metadata string"


def test_merges(spark, written):
    e = spark.createDataFrame([("P1", "person", "Ada Quist", None, "{}"), ("P2", "person", "MR. ADA QUIST", None, "{}"), ("P3", "person", "Mr. Lind", None, "{}"), ("P4", "person", "Bo Lind", None, "{}"), ("O1", "organization", "Ada Quist", None, "{}")], PERSON)
    r = spark.createDataFrame([(1, "P1", "P4", "x", 1.0), (2, "P2", "P4", "x", 5.0), (3, "P1", "P2", "x", 1.0)], EDGE).withColumn("source_documents", F.array(F.concat(F.lit("EFTA00000"), "relationship_id")))
    found = cleanup.merge_candidates(e, r)
    assert sorted((x.survivor_id, x.absorbed_id, x.reason, x["pass"]) for x in found.collect()) == [("P1", "P2", "title_prefix; all_caps_variant", 1), ("P4", "P3", "lastname_only_unambiguous", 2)]
    merges = cleanup.applied_merges(spark, found, written)
    s = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "id long, relationship_id long, source_system string")
    log = spark.createDataFrame([("P2", "x")], "canonical_id string, source_system string")
    out = cleanup.apply_merges({"canonical_entities": e, "relationships": r, "relationship_sources": s, "entity_resolution_log": log}, merges)
    assert {x.canonical_id: x.aliases for x in out["canonical_entities"].collect()} == {"P1": ["MR. ADA QUIST"], "P4": ["Mr. Lind"], "O1": []}
    assert [(x.relationship_id, x.source_entity_id, x.weight, x.source_documents) for x in out["relationships"].collect()] == [(2, "P1", 6.0, ["EFTA000001", "EFTA000002"])]
    assert rows(out["relationship_sources"].select("id", "relationship_id")) == [(1, 2), (2, 2)]
    assert out["entity_resolution_log"].first().canonical_id == "P1"


def test_merges_keep_metadata_of_absorbed_entities(spark):
    e = spark.createDataFrame([("P1", "person", "Ada", None, '{"mentions": 2, "role": "x"}'), ("P2", "person", "A", None, '{"mentions": 10, "role": "y", "category": ["z"]}'), ("P3", "person", "B", None, '{"exclude_from_analysis": true}'), ("P4", "person", "C", None, None), ("P5", "person", "D", None, '{"k": 1}')], PERSON)
    r = spark.createDataFrame([(1, "P1", "P5", "x", 1.0)], EDGE).withColumn("source_documents", F.array().cast("array<string>"))
    s = spark.createDataFrame([(1, 1, "a")], "id long, relationship_id long, source_system string")
    log = spark.createDataFrame([("P2", "x")], "canonical_id string, source_system string")
    merges = spark.createDataFrame([("P2", "P1"), ("P3", "P1"), ("P4", "P1")], "absorbed_id string, survivor_id string")
    out = cleanup.apply_merges({"canonical_entities": e, "relationships": r, "relationship_sources": s, "entity_resolution_log": log}, merges)["canonical_entities"]
    assert {x.canonical_id: x.metadata for x in out.collect()} == {"P1": '{"mentions": 10, "role": "x", "category": ["z"], "exclude_from_analysis": true}', "P5": '{"k": 1}'}
    assert [x.canonical_id for x in cleanup.excluded_ids(out).collect()] == ["P1"]


def test_lists_in_metadata_are_united():
    assert cleanup.merged_json('{"l": ["A", 1], "b": true}', ['{"l": ["a", "c", 1], "b": false}', '{"l": [{"x": 1}]}']) == '{"l": ["A", 1, "c", {"x": 1}], "b": true}'


def test_three_way_consolidation_sums(spark):
    r = spark.createDataFrame([(i, "a" if i % 2 else "b", "b" if i % 2 else "a", "x", float(i)) for i in (1, 2, 3)] + [(4, "a", "a", "x", 9.0)], EDGE).withColumn("source_documents", F.array().cast("array<string>"))
    assert [(x.relationship_id, x.weight) for x in cleanup.consolidate(r).collect()] == [(3, 6.0)]


def test_replay_skips_what_is_gone():
    assert cleanup.replay([("a", "b"), ("b", "c"), ("d", "a"), ("e", "b"), ("f", "f")]) == {"b": "a", "a": "d"}


def test_metadata_merge(spark):
    row = spark.createDataFrame([({"n": "2", "f": "false", "s": "x"}, {"n": "10", "f": "true", "s": "y", "t": "z"})], "a map<string,string>, b map<string,string>")
    assert row.select(cleanup.merge_metadata(F.col("a"), F.col("b"))).first()[0] == {"n": "10", "f": "true", "s": "x", "t": "z"}


def test_noise_is_deleted_or_flagged(spark):
    e = spark.createDataFrame([("P1", "person", "Mary", None, '{"a": 1}'), ("P2", "person", "Victim #2", None, None), ("P3", "person", "Ada Quist", None, "{}"), ("P4", "person", "Judge", None, '{"exclude_from_analysis": true}')], PERSON)
    r = spark.createDataFrame([(i, "P1", f"x{i}", "t", 1.0) for i in range(51)] + [(99, "P2", "P3", "t", 1.0)], EDGE)
    noise = cleanup.noise_entities(e, r)
    assert rows(noise.select("canonical_id", "action")) == [("P1", "flag"), ("P2", "delete")]
    flagged = cleanup.flag_entities(e, noise.where("action = 'flag'"))
    assert rows(cleanup.excluded_ids(flagged)) == [("P1",), ("P4",)]
    s = spark.createDataFrame([(1, 99), (2, 0)], "id long, relationship_id long")
    out = cleanup.delete_entities({"canonical_entities": e, "relationships": r, "relationship_sources": s, "entity_resolution_log": e.select("canonical_id")}, noise.where("action = 'delete'"))
    assert out["relationships"].count() == 51 and rows(out["relationship_sources"].select("id", "relationship_id")) == [(2, 0)] and out["canonical_entities"].count() == 3


def test_name_cleanup_keeps_the_old_name(spark):
    e = spark.createDataFrame([("P1", "person", "DR. ADA QUIST", None, None), ("P2", "person", "Bo Orr", None, None)], PERSON)
    assert rows(cleanup.name_cleanups(e)) == [("P1", "DR. ADA QUIST", "Ada Quist")]
    assert rows(cleanup.apply_name_cleanups(e).select("canonical_name", "aliases")) == [("Ada Quist", ["DR. ADA QUIST"]), ("Bo Orr", [])]


def test_phrases_ignore_punctuation_but_not_word_ends(spark):
    pages = spark.createDataFrame([(1, "d1", "Saw Ann, Lee; and ANN LEE."), (2, "d1", "annie lee"), (3, "d2", "ann lee"), (4, "d3", None)], "page int, doc string, text string")
    terms = spark.createDataFrame([("Ann Lee",), ("saw",), ("nobody",)], "term string")
    hits = corpus.phrase_hits(pages, terms)
    assert rows(corpus.document_counts(hits)) == [("Ann Lee", 2), ("saw", 1)]
    pair = spark.createDataFrame([("Ann Lee", "saw")], "term_a string, term_b string")
    assert rows(corpus.phrase_cooccurrence(hits, pair)) == [("Ann Lee", "saw", 1, ["d1"])]
    assert rows(corpus.document_counts(corpus.substring_hits(pages, terms))) == [("Ann Lee", 2), ("saw", 1)]


def test_first_variant_wins_equal_counts(spark):
    names = spark.createDataFrame([("p", 0, "x"), ("p", 1, "y"), ("q", 0, "z")], "canonical_id string, pos int, term string")
    counts = spark.createDataFrame([("x", 3), ("y", 3)], "term string, document_count long")
    assert rows(corpus.best_search_term(names, counts)) == [("p", "x", 3)]


def test_substrings_of_all_terms(spark):
    pages = spark.createDataFrame([(k, k % 50, f"so <T{k}> it is") for k in range(620)], "page long, doc long, text string")
    terms = spark.createDataFrame([(f"<t{k}>",) for k in range(620)], "term string")
    assert corpus.document_counts(corpus.substring_hits(pages, terms)).count() == 620


def test_mentions_corroborate_discover(spark):
    e = spark.createDataFrame([(i, "person", n, None, None) for i, n in (("P1", "Ann Lee"), ("P2", "Bo Orr"), ("P3", "Cyd Fay"))], PERSON)
    r = spark.createDataFrame([(1, "P1", "P2", "x", 1.0)], EDGE).withColumn("source_documents", F.array(F.lit("EFTA000001")))
    s = spark.createDataFrame([(1, "registry")], "relationship_id long, source_system string")
    pages = spark.createDataFrame([(i, f"d{i:02d}", "ann lee and bo orr and cyd fay") for i in range(12)], "page int, doc string, text string")
    mentions = corpus.mention_counts(e, r, pages)
    assert rows(mentions) == [("P1", "Ann Lee", 12), ("P2", "Bo Orr", 12), ("P3", "Cyd Fay", 12)]
    assert [(x.relationship_id, x.document_count, len(x.sample)) for x in corpus.corroborate(e, r, s, pages).collect()] == [(1, 12, 12)]
    assert rows(corpus.discover(e, mentions, r, pages).select("source_entity_id", "target_entity_id", "weight")) == [("P1", "P3", 12.0), ("P2", "P3", 12.0)]
    assert rows(corpus.coverage(e, mentions, r).select("canonical_id", "documents_in_knowledge_graph", "unanalyzed_count")) == [("P1", 1, 11), ("P2", 1, 11), ("P3", 0, 12)]
    extracted = spark.createDataFrame([(0, "ANN LEE", 4), (1, "ann lee", 7), (2, "bo orr", 0)], "pos int, entity_value string, document_count int")
    assert rows(corpus.coverage_extracted(e, extracted, r).select("canonical_id", "total_documents_mentioning", "connections")) == [("P1", 7, 0)]


def test_timeline_and_anomalies(spark):
    r = spark.createDataFrame([(1, "a", "b", "2008-06-15", None), (2, "a", "b", None, "2008"), (3, "a", "b", None, None)], "relationship_id long, source_entity_id string, target_entity_id string, date_start string, date_end string").withColumn("relationship_type", F.lit("x"))
    e = spark.createDataFrame([("a", "A"), ("b", "B")], "canonical_id string, canonical_name string")
    got = temporal.relationship_timeline(r, e, temporal.events_table(spark, {"2008-06": "event"}))
    assert rows(got.select("relationship_id", "nearby_event")) == [(1, "event"), (2, "")]
    months = spark.createDataFrame([("m1",)] * 50 + [(f"n{i}",) for i in range(9)] + [(None,)], "month string")
    assert [r.period for r in temporal.volume_anomalies(months, "month").collect()] == ["m1"]
    assert temporal.events_table(spark).count() == 0


def test_conflicts(spark, edges):
    s = spark.createDataFrame([(1, 1, "a", "t1"), (2, 1, "a", "t2"), (3, 1, "b", ""), (4, 4, "a", "y"), (5, 4, "b", "y")], "id long, relationship_id long, source_system string, source_relationship_type string")
    assert rows(conflicts.relationship_types(edges, s).select("relationship_id", "value_a", "value_b")) == [(1, "t2", "x")]
    c = spark.createDataFrame([("p", "s1", "victim", 1), ("p", "s2", "x", 1), ("q", "s1", "other", 1), ("q", "s2", "associate", 1), ("r", "s1", "x", 1), ("t", "s1", "x", 1), ("t", "s2", "other", 1)], "canonical_id string, source_system string, category string, seq int")
    roles = spark.createDataFrame([("r", "pilot", 2, 0)], "canonical_id string, role string, n int, pos int")
    assert rows(conflicts.entity_categories(c, roles).select("canonical_id", "severity")) == [("p", "medium"), ("t", "low")]
    assert rows(conflicts.entity_categories(c, roles, strict=True).select("canonical_id")) == [("p",)]


def test_priorities_add_up_by_name(spark):
    e = spark.createDataFrame([("P1", "person", "Ada"), ("P2", "person", "Bo"), ("P3", "person", "The Author")], "canonical_id string, entity_type string, canonical_name string")
    r = spark.createDataFrame([(1, "P1", "P2", "x", 1.0), (2, "P1", "P3", "x", 1.0), (3, "P1", "P3", "x", 1.0)], EDGE)
    none = spark.createDataFrame([], "canonical_id string")
    weak = spark.createDataFrame([("Ada", "Bo"), ("Ada", "Cyd"), ("Ada", "Cyd")], "source_name string, target_name string")
    gaps = spark.createDataFrame([("Bo", "Ada")], "entity_a string, entity_b string")
    bridges = spark.createDataFrame([("Ada", 4), ("Bo", 2)], "entity string, communities_connected int")
    wrong = spark.createDataFrame([("Ada", "f", "medium"), ("Ada", "f", "low")], "entity_a string, field string, severity string")
    cover = spark.createDataFrame([("P2", "Bo", 100)], "canonical_id string, canonical_name string, unanalyzed_count int")
    out = prioritize.priorities([prioritize.prominence_factor(e, r, none), prioritize.coverage_factor(cover), prioritize.weak_factor(weak), prioritize.gap_factor(gaps), prioritize.bridge_factor(bridges), prioritize.contradiction_factor(wrong)])
    got = {x.canonical_name: (round(x.priority_score, 6), x.factors) for x in out.collect()}
    assert got == {"Ada": (4 + 9 + 5 + 12 + 7, "weak_relationships:3; structural_gaps:1; bridges:4_communities; contradiction:f:low; contradiction:f:medium"), "Bo": (2 + 10 + 5, "document_gap:100_unanalyzed; structural_gaps:1")}


def test_validation(spark, edges):
    e = spark.createDataFrame([("a", "person", "Ada", None), ("b", "person", "ADA", None)], "canonical_id string, entity_type string, canonical_name string, metadata string")
    assert rows(validate.orphans(edges, e)) == [(4, "b", "c")]
    assert [(r.name, r.ids) for r in validate.duplicate_names(e).collect()] == [("ada", "a, b")]
    assert {r.direction for r in validate.connections(edges, e, "a").collect()} == {"in", "out"}


def test_merges_in_rounds_follow_the_ordered_replay(spark, written):
    import random

    r = random.Random(3)
    pairs = [(1, f"k{r.randrange(12)}", f"e{r.randrange(25)}", f"e{r.randrange(25)}") for _ in range(60)]
    df = spark.createDataFrame(pairs, "pass int, match_key string, survivor_id string, absorbed_id string")
    want = cleanup.replay((s, a) for _, _, s, a in sorted(set(pairs)))
    assert {x.absorbed_id: x.survivor_id for x in cleanup.applied_merges(spark, df, written).collect()} == want
    assert cleanup.applied_merges(spark, df.where("false"), written).count() == 0


def test_long_phrases_and_many_aliases(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    pages = spark.createDataFrame([(1, "d", f"x {text} y"), (2, "e", text.replace("fourteen", "more"))], "page int, doc string, text string")
    hits = corpus.phrase_hits(pages, spark.createDataFrame([(text.title(),), ("five six",)], "term string"))
    assert rows(hits.select("page", "term")) == [(1, text.title()), (1, "five six"), (2, "five six")]
    assert corpus.phrase_hits(pages, spark.createDataFrame([], "term string")).count() == 0
    registry = spark.createDataFrame([("A", "Zed Quux", [f"Nobody Like{k:05d}" for k in range(1500)] + ["Anna Lindqvist"], 1), ("B", "Anna Lindqvisd", None, 2)], "canonical_id string, canonical_name string, aliases array<string>, seq long")
    probes = spark.createDataFrame([(1, "Anna Lindqviss")], "key int, name string")
    assert [(r.canonical_id, r.match_method) for r in resolve.resolve(probes, registry).collect()] == [("A", "fuzzy")]  # a tie goes to the first entry


def test_metadata_fields(spark):
    entities = spark.createDataFrame([("a", '{"x": 1, "roles": {"p": 2}}'), ("b", None), ("c", "{}")], "canonical_id string, metadata string")
    added = spark.createDataFrame([("a", '{"x": 5, "y": true, "roles": {"p": 1, "q": 1}}'), ("b", '{"z": "t"}')], "canonical_id string, fields string")
    import json

    got = {r.canonical_id: json.loads(r.metadata) for r in cleanup.with_metadata(entities, added).collect()}
    assert got == {"a": {"x": 5, "y": True, "roles": {"p": 3, "q": 1}}, "b": {"z": "t"}, "c": {}}
    filled = {r.canonical_id: json.loads(r.metadata) for r in cleanup.with_metadata(entities, added.select("canonical_id", F.get_json_object("fields", "$.x").alias("x")).where("x is not null").select("canonical_id", F.lit('{"x": 5, "y": true}').alias("fields")), fill=True).collect() if r.metadata}
    assert filled == {"a": {"x": 1, "y": True, "roles": {"p": 2}}, "c": {}}


def test_equal_names_meet_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return len(x)

    reach = resolve.similarity.may_reach
    told = F.udf(counted, "int").asNondeterministic()
    monkeypatch.setattr(resolve.similarity, "may_reach", lambda a, b, cutoff: reach(a, b, cutoff) & (told(a) > 0))
    left = spark.range(500).select(F.col("id").alias("key"), F.lit("Ada Quist").alias("a"))
    right = spark.createDataFrame([(1, "Ada Quist"), (2, "Ada Quist"), (3, "Gus Novak")], "id long, b string")
    assert resolve.similar_candidates(left, right).groupBy("id").count().orderBy("id").collect() == [(1, 500), (2, 500)]
    assert seen.value < 100
