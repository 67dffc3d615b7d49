"""The corpus pipeline, stage by stage, on a small corpus with known cases."""

import random

import pytest

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from corroba.llm import queries

R = random.Random(11)
WORDS = ["".join(R.choice("abcdefghij") for _ in range(R.randint(2, 8))) for _ in range(600)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("sf")
    item = prose(30, 9000)
    docs = [(i, prose(150, i)) for i in range(200)]
    docs += [(200 + i, " ".join(f"{w}###" for w in prose(150, 300 + i).split())) for i in range(60)]
    docs += [(300, prose(150, 5)), (301, prose(150, 5).replace(" ", "\n", 3)), (302, f"{prose(60, 1)} {item} {prose(60, 2)}"), (303, f"{prose(80, 3)} joe@mail.example.com {prose(80, 4)}"), (304, None), (305, prose(5000, 7))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in range(260)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        kept.append({r.doc_id: r for r in docs.collect()})
    accepted, single, clean, redacted = kept
    assert not set(range(200, 260)) & set(accepted) and set(range(200)) <= set(accepted)
    assert 5 in single and not {300, 301} & set(single)
    assert set(single) - set(clean) == {302}
    assert set(redacted) == set(clean) and "joe@" not in redacted[303].text and "[EMAIL]" in redacted[303].text
    assert redacted[303].n_chars == len(redacted[303].text)
    assert {i: r.text for i, r in redacted.items() if i != 303} == {i: r.text for i, r in clean.items() if i != 303}


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} >= set(range(200)) - {5} and not {r.doc_id for r in got} & {*range(200, 260), 300, 301, 302}
    assert all(0 < r.length <= 2048 for r in got)


def test_ten_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and len(queries.QUERIES) == 10 and len(corpus_pipeline.STAGES) == 5


def jaccard(a, b):
    grams = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in (a, b))]
    return len(grams[0] & grams[1]) / len(grams[0] | grams[1])


def test_near_copies_with_edited_words_are_one(spark):
    """Against all pairs: edited copies, a large group of them, a passage that many texts share, copies and blanks."""
    r, texts = random.Random(5), []
    for k in range(60):
        words = prose(r.randint(20, 200), 2000 + k).split()
        for edits in (0, 1, 2, 4):
            new = list(words)
            for _ in range(edits):
                new[r.randrange(len(new))] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(new))
    group = prose(150, 3000).split()
    for k in range(40):
        texts.append(" ".join(w if i != 3 * k else f"one{k}" for i, w in enumerate(group)))
    texts += [f"{prose(40, 3001)} {prose(30, 3100 + k)}" for k in range(40)]
    texts += [texts[5], texts[5].upper(), None, "", " ", "two words", "two  words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            blank = not (texts[i] or "").strip(), not (texts[j] or "").strip()
            if all(blank) or not any(blank) and jaccard(texts[i], texts[j]) >= 0.8:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    got = sorted(x.doc_id for x in corpus_pipeline.deduplicate(spark, docs, "").collect())
    assert got == sorted({top(i) for i in range(len(texts))})
    assert corpus_pipeline.deduplicate(spark, docs.limit(0), "").count() == 0


def test_stages_on_odd_tables(spark, tmp_path):
    """No documents, no labels, no benchmark; null and repeated ids, null texts, columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, prose(60, i), "en", "s", 1) for i in range(20)] + [(None, prose(60, 500), None, None, None), (None, None, None, None, None), (3, prose(60, 501), "en", "s", 2), (3, prose(60, 3), "en", "s", 1), (21, "", "", "", 0)]
    for name, docs in (("odd", rows), ("none", [])):
        out = str(tmp_path / name)
        df = spark.createDataFrame(docs, schema)
        for c in ("row", "fp", "score", "key", "part", "best", "item_id", "spans"):
            df = df.withColumn(c, F.lit("clash"))
        df.write.parquet(f"{out}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
        now = spark.read.parquet(f"{out}/documents.parquet")
        for stage, step in corpus_pipeline.STAGES[:-1]:
            now = step(spark, now, out)
            assert now.columns == df.columns, stage
            assert now.where("`row` <> 'clash' or fp <> 'clash' or best <> 'clash'").count() == 0
        kept = sorted((r.doc_id is None, r.doc_id or 0) for r in now.collect())
        assert kept == (sorted([(False, i) for i in range(20)] + [(False, 3), (False, 21), (True, 0)]) if docs else [])
        packed = corpus_pipeline.STAGES[-1][1](spark, now, out)
        assert packed.count() == len(kept)
