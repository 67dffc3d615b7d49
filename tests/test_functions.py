import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corroba.functions import docids, names, scoring, similarity


def values(spark, inputs, column):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").select("i", column(F.col("x")).alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.i)]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (names.normalize_name, {"DOE-SMITH, ANNA B.": "ANNA B. DOE-SMITH", "Omar Lind (pilot), Esq.": "Omar Lind", "Duke of Y, X": "X Duke of Y", "A  B Jr. Esq.": "A B", "": "", None: "", ", X": ", X", "Lind Esq. Jr.": "Lind Esq."}),
        (names.short_name, {"Ada Berta Cyd Quist": "Ada Quist", "Ada Quist": "Ada Quist", "Ada": "Ada"}),
        (names.strip_titles, {"Dr. Prof. Ada Quist": "Ada Quist", "judge Judge X": "X", "Drake": "Drake"}),
        (names.to_title_case, {"JEAN-LUC NOVAK": "Jean-Luc Novak", "Ada QUIST": "Ada Quist", "Berta QUIST": "Berta QUIST", "J.D. ORR": "J.d. Orr", "M. ORR": "M. Orr", "O'BRIEN": "O'brien", "12": "12"}),
        (names.clean_name, {"Ada Ada Quist": "ada quist", "Ada B. Quist": "ada quist", "MR. QUIST": "quist", "A B C D": "a d", "Jean-Luc Orr": "jean luc orr", "Ada Ada": "ada ada", None: ""}),
        (names.display_name, {"DR. ADA QUIST": "Ada Quist", "FBI": "Fbi", "King County": "County", "Ada Ada Quist": "Ada Quist"}),
        (names.is_redaction_marker, {"(b)(6)": True, "x [REDACTED] y": True, "": True, None: True, "N/A": True, "X": True, "Ada": False}),
        (names.is_noise_name, {"Port Authority": True, "Victim #2": True, "Ada Quist": False, "a@b.c": True, "12 34": True, "one two three four five six seven eight": True, "x" * 91: True, "Unknown": True}),
        (names.is_numbered_reference, {"Jane Doe #1": True, "Employee-2": True, "Detective 3": True, "Ada": False}),
        (names.is_expanded_noise, {"mary": True, "Mary Orr": False, "Roger ?": True, "J.D.": True, "Éa": True, "judge": True, "Ada Quist": False}),
        (names.noise_reason, {"Judge": "generic_word:judge", "Mary": "standalone_first_name:mary", "Roger ?": "question_mark_placeholder", "Victim #2": "base_noise_filter", "J.D.": "pattern_match:J.D."}),
        (names.is_graph_noise, {"The Author": True, "Ada": False}),
        (names.is_ranking_noise, {"": True, "Whistleblower X": True, "Ada": False, "(b)(7)": True}),
        (names.action_type, {"recalled": "communicated_with", "was unpaid": "financial", "flew with": "traveled_with", "saw": "associated_with", None: "associated_with"}),
        (docids.extract_efta, {"see efta00012345.pdf": "EFTA00012345", "EFTA123": None, "xEFTA123456": None}),
        (docids.extract_doj_ogr, {"doj_ogr 77": "DOJ-OGR-00000077", "DOJ OGR-123456789": "DOJ-OGR-123456789", "ogr 1": None}),
        (docids.raw_key, {" 1:23-cv-1 ": "RAW-" + hashlib.sha1(b"1:23-cv-1").hexdigest()[:12], "": "RAW-000000000000", None: "RAW-000000000000"}),
    ],
)
def test_scalar(spark, function, cases):
    assert dict(zip(cases, values(spark, list(cases), function), strict=True)) == cases


def test_protected_words(spark):
    assert values(spark, ["judge"], lambda c: names.is_expanded_noise(c, protected=("judge",))) == [False]


def test_scores(spark):
    rows = spark.createDataFrame([(1, 0.5, 1), (2, 2.5, 5), (3, 3.0, 10), (0, 0.0, 0)], "n int, p double, d int")
    got = [r[0] for r in rows.select(scoring.corroboration_score(F.col("n"), F.col("p"), F.col("d"))).collect()]
    assert [round(x, 3) for x in got] == [0.330, 0.829, 0.920, 0.05]


def test_evidence_class_and_weight(spark):
    rows = spark.createDataFrame([(None, "Triples "), ("curated", "x"), ("", "corpus"), (None, None)], "c string, s string")
    kind = scoring.evidence_class(F.col("c"), F.col("s"))
    assert [tuple(r) for r in rows.select(kind, scoring.evidence_weight(kind)).collect()] == [("rdf", 1.0), ("curated", 1.5), ("corpus_cooccurrence", 0.9), ("other", 0.6)]


def test_evidence_doc_keys(spark):
    told = values(spark, ['{"doc_keys": ["file 9", "EFTA00000001"], "doc_id": 77, "metadata": {"efta": "doj ogr 3"}}'], scoring.evidence_doc_keys)[0]
    assert told[:2] == ["DOJ-OGR-00000003", "EFTA00000001"] and len(told) == 4 and all(x.startswith("RAW-") for x in told[2:])
    assert values(spark, ['{"a": ["efta00000001", "x DOJ-OGR-5 y"], "b": {"c": "RAW-0123456789ab EFTA00000001"}}'], scoring.evidence_doc_keys) == [["DOJ-OGR-00000005", "EFTA00000001", "RAW-0123456789ab"]]


def test_merge_documents(spark):
    rows = spark.createDataFrame([(["RAW-b", "EFTA2", "x"], ["DOJ-OGR-1", "efta1", "EFTA2", ""]), (None, ["EFTA1"])], "a array<string>, b array<string>")
    assert [r[0] for r in rows.select(docids.merge_documents(F.col("a"), F.col("b"))).collect()] == [["efta1", "EFTA2", "DOJ-OGR-1", "RAW-b", "x"], ["EFTA1"]]
    assert rows.select(docids.merge_documents(F.col("a"), F.col("b"), 2)).first()[0] == ["efta1", "EFTA2"]


def test_canonicalize_knows_the_whole_crosswalk(spark):
    refs = spark.createDataFrame([(1, "DOJ-OGR-7", None), (2, "EFTA000001 DOJ OGR 7", "x"), (3, " a ", "b")], "seq int, f string, g string")
    links = docids.crosswalk(docids.canonicalize(refs, ["f", "g"]))
    got = {r.seq: (r.doc_key, r.raw_id) for r in docids.canonicalize(refs, ["f", "g"], links).collect()}
    assert got[1][0] == got[2][0] == "EFTA000001"
    assert got[3] == ("RAW-" + hashlib.sha1(b"a | b").hexdigest()[:12], "a | b")


def test_upsert_keeps_last_value_that_is_not_null(spark):
    rows = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("k", 3, None, None)], "doc_key string, seq int, efta string, ogr string")
    assert [tuple(r) for r in docids.upsert(rows).collect()] == [("k", "a", "b")]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(0, 15))) for _ in range(2))
        assert similarity.longest_common_subsequence(a, b) == lcs(a, b)
