"""Each operator against brute force, and on odd tables: nulls, blanks, long texts, ties, repeats, nothing, extra columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from corroba.llm import _shingle_sets as S
from corroba.llm import _text as T
from corroba.llm import decontamination, masked_lm, packing, pii, quality_classifier, quality_rules, secret_scan, simhash_dedup, slot_sharding, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
R = random.Random(4)
WORDS = ["".join(R.choice("abcdefgh") for _ in range(R.randint(1, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(60_000, 99)
TEXTS = [prose(120, 1), prose(120, 1), prose(120, 1) + " x", prose(300, 2), prose(70, 3), "", None, " \n\t", "Aé ÅΣ 😀 ǅ", "word", LONG, "a b\na b\na b\n\nc", prose(9, 5) + "\n" + prose(60, 6) * 2]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, repeated and without id, and columns whose names operators use inside."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], "en", "s", 1), (None, "no id here", None, None, None), (None, None, None, None, None), (3, "other text", "en", None, 10)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "fp", "key", "score", "label", "part", "size", "component_id", "slot", "__kept", "group", "h", "n"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (0, 0, 0), (4, None, 0), (None, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def ids_texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(v):
    return tuple((x is None, x) for x in v)


# ---- SimHash near-dedup ----


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = fold(t).encode().split()
    grams = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def components_of(rows):
    """Each row's fingerprint, and the first row of its component."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    while True:
        new = [min(group[j] for j in range(len(rows)) if (fps[i] ^ fps[j]).bit_count() <= 4) for i in range(len(rows))]
        if new == group:
            return fps, group
        group = new


def dedup_reference(rows):
    fps, group = components_of(rows)
    low = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[i][0], f"{fps[i]:016x}", low[group[i]]) for i in range(len(rows))), key=key)


def test_near_duplicates(odd, empty):
    got = simhash_dedup.near_duplicates(odd)
    assert sorted((tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()), key=key) == dedup_reference(ids_texts(odd))
    assert simhash_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_buckets_that_are_divided_lose_nothing(spark, bucket_rows):
    r = random.Random(7)
    rows = []
    for base in range(6):
        words = prose(150, 100 + base).split()
        for _ in range(r.randint(1, 25)):
            w = list(words)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            rows.append((len(rows), " ".join(w), "en", "s", 0))
    df = spark.createDataFrame(rows, SCHEMA)
    got = simhash_dedup.near_duplicates(df, bucket_rows=bucket_rows)
    assert sorted((tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()), key=key) == dedup_reference([(r[0], r[1]) for r in rows])


def test_keep_one_keeps_the_smallest_id_once(spark, odd, empty):
    df = odd.withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumn("_row", F.lit("clash"))
    kept = simhash_dedup.keep_one(df)
    assert kept.columns == df.columns and kept.where("`__kept` = 'clash' and `row` = 'clash' and `_row` = 'clash' and m['k'] = 1").count() == kept.count()
    sets = lambda t: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := fold(t).split()) else set()
    rows = ids_texts(odd)
    grams = [sets(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if grams[i] == grams[j] or 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]) > 0:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    low = {}
    for (i, _), g in zip(rows, group, strict=True):
        low[g] = min([x for x in (i, low.get(g)) if x is not None], default=None)
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(low.values())
    assert simhash_dedup.keep_one(empty).count() == 0


@pytest.mark.parametrize("turn", ["nearest", "all"])
def test_large_buckets_are_compared_in_tiles(spark, turn):
    """Sets that share a shingle in their prefix, in parts of three members: the pairs of the undivided bucket."""
    r, base = random.Random(8), prose(80, 55).split()
    rows = [(k, " ".join(r.choice(WORDS) if r.random() < 0.02 else w for w in base)) for k in range(40)]
    df = spark.createDataFrame(rows, "row long, text string")
    sets = S.texts_of(df, ["row"], "text").dropDuplicates(["fp"])
    members = S.buckets(S.prefixes(df, S.common_shingles(df, len(rows), "text"), "text")).join(sets.select("fp", "n", "sketch"), "fp").cache()
    assert members.agg(F.max("members")).first()[0] > 6
    grams = {x.fp: set(x.grams) for x in S.whole_sets(df, "text").collect()}
    similar = {(a, b) for a in grams for b in grams if a < b and 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b])}
    fps = sorted(grams)
    for roots in ([], [(f, fps[0]) for f in fps[: len(fps) // 2]], [(f, fps[0]) for f in fps]):
        named = spark.createDataFrame(roots, "fp long, root long")
        of = {f: root for f, root in roots}
        whole, tiled = ({(x.a, x.b) for x in S.candidates(members, named, turn, part).collect()} for part in (1 << 20, 3))
        apart = {(a, b) for a, b in similar if of.get(a, a) != of.get(b, b)}
        if turn == "all":
            assert tiled == whole and tiled >= apart
        else:
            assert tiled >= whole and all(any(f in x for x in tiled) for pair in apart for f in pair)
    members.unpersist()


def test_hot_buckets_are_found_by_salts(spark):
    """Members of frequent shingles, found in parts, and of rare ones: each set of two or more texts is one bucket."""
    r, base = random.Random(9), prose(60, 56).split()
    texts = [" ".join(r.choice(WORDS) if r.random() < 0.02 else w for w in base) for _ in range(150)]
    texts += [" ".join(base[:30])] * 90 + [t for k in range(6) for t in (prose(50, 300 + k), prose(50, 300 + k) + " tail")]
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3).cache()
    common = S.common_shingles(df, len(texts), "text")
    sent = [tuple(x) for x in S.prefixes(df, common, "text").collect()]
    assert {x[1] >= 0 for x in sent} == {True, False}
    assert max(collections.Counter(sent).values()) <= 3  # equal texts send a shingle once in each task
    held = collections.defaultdict(set)
    for bucket, _, fp in sent:
        held[bucket].add(fp)
    found = collections.defaultdict(list)
    for x in S.buckets(S.prefixes(df, common, "text")).collect():
        found[x.bucket].append((x.fp, x.members))
    assert all(len(v) == len(set(v)) and {m for _, m in v} == {len(v)} for v in found.values())
    sets = [frozenset(f for f, _ in v) for v in found.values()]
    assert len(sets) == len(set(sets)) and set(sets) == {frozenset(v) for v in held.values() if len(v) > 1}
    assert max(map(len, sets)) > 60
    df.unpersist()


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in simhash_dedup.components(links).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[1001] == 1000


# ---- quality classifier ----


def quality_tables(spark, n=500):
    rows, known = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(f"{w}###" for w in prose(80, i).split()) if bad else prose(80, i)
        rows.append((i, text, "en", "s", len(text)))
        known.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    docs, known = quality_tables(spark)
    out = quality_classifier.classify(docs, known).join(known, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97


def test_classifier_never_learns_from_held_out_rows(spark):
    docs, known = quality_tables(spark, 120)
    held = quality_classifier.held_out()
    first = quality_classifier.fit(docs, known, among=~held)
    wrong = known.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(first, quality_classifier.fit(docs, wrong, among=~held))


def test_classifier_sample_is_bounded(spark):
    docs, known = quality_tables(spark, 120)
    assert not np.array_equal(quality_classifier.fit(docs, known, sample=10), quality_classifier.fit(docs, known))


def test_margins_are_sparse_dot_products():
    w = np.random.default_rng(0).normal(size=(1 << quality_classifier.BITS) + 1)
    column = pa.array([t for t in TEXTS if t != LONG], pa.string())
    rows = quality_classifier.rows_of(column)
    want = [w[-1] + float(w[at].astype(np.float64) @ x) for at, x in rows]
    assert np.allclose(quality_classifier.margins(column, w), want, rtol=1e-4, atol=1e-3)


def test_classifier_on_odd_tables(odd, empty, labels):
    got = quality_classifier.classify(odd, labels)
    assert got.count() == odd.count() and got.where("score is null or held_out is null").count() == 0
    assert quality_classifier.classify(empty, labels).count() == 0
    plain = quality_classifier.classify(odd, labels.where("false")).collect()
    assert {r.score for r in plain} == {0.5}
    kept = quality_classifier.accepted(odd, np.zeros((1 << quality_classifier.BITS) + 1))
    assert kept.columns == odd.columns and kept.count() == odd.count()


# ---- decontamination ----


def contamination_reference(docs, items):
    def grams(t):
        w = fold(t).split()
        return [tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [])

    out = {}
    for d, t in docs:
        g = grams(t)
        for i, s in items:
            c = collections.Counter(grams(s))
            m = min(sum(c.values()), len(g))
            best = 0
            if m and set(c) & set(g):
                for k in range(len(g) - m + 1):
                    shared = sum((collections.Counter(g[k : k + m]) & c).values())
                    best = max(best, shared / (sum(c.values()) + m - shared))
            if best >= 0.8:
                out[d, i] = round(best, 9)
    return out


def test_decontamination_against_all_windows(spark):
    r = random.Random(5)
    items = [(i, prose(r.randint(3, 60), 500 + i)) for i in range(25)] + [(90, None), (91, ""), (92, " "), (93, prose(20, 500))]

    def edited(t):
        w = t.split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        return " ".join(w)

    docs = [(0, None), (1, "")] + [(i, " ".join([prose(r.randint(0, 80), 900 + i), edited(r.choice(items[:25])[1]).upper(), prose(r.randint(0, 40), 1900 + i)])) for i in range(2, 120)]
    d = spark.createDataFrame([(i, t, None, None, 0) for i, t in docs], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = contamination_reference(docs, items)
    got = {(x.doc_id, x.item_id): round(x.similarity, 9) for x in decontamination.matches(d, b).collect()}
    assert want and got == want
    kept = {x.doc_id for x in decontamination.clean(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_a_very_long_text_is_searched_in_stretches(spark):
    item, shared = prose(40, 7000), prose(8, 7001)
    long = " ".join([prose(30_000, 7002), item, shared, prose(30_000, 7003), shared] + [f"{shared} {prose(3, 7100 + k)}" for k in range(500)])
    items = [(1, item)] + [(2 + k, f"{shared} {prose(12 + k % 5, 7200 + k)}") for k in range(300)]
    got = decontamination.matches(spark.createDataFrame([(0, long)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.item_id, r.similarity, r.first_word) for r in got] == [(1, 1.0, 30_000)]


def test_decontamination_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(30, i)) for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, prose(30, i)) for i in range(0, 20, 2)], "item_id long, text string")
    whole = sorted(tuple(r) for r in decontamination.matches(docs, bench).collect())
    monkeypatch.setattr(decontamination, "ITEMS", 3)
    assert sorted(tuple(r) for r in decontamination.matches(docs, bench).collect()) == whole and len(whole) == 10


def test_decontamination_on_odd_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, TEXTS[4]), (2, TEXTS[4]), (3, None), (4, "no id here")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted(((r.doc_id, r.item_id) for r in decontamination.matches(odd, bench).collect()), key=key)
    assert got == [(4, 1), (4, 2), (None, 4)]
    assert decontamination.matches(empty, bench).count() == decontamination.matches(odd, bench.where("false")).count() == 0
    kept = decontamination.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert decontamination.clean(odd, bench.where("false")).count() == odd.count()


# ---- personal data ----

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def pii_reference(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    return (
        [("email", *m.span()) for m in EMAIL.finditer(t)]
        + [("ip", *m.span()) for m in IP.finditer(t) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
        + [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
        + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    )


def test_base_spans_against_the_patterns():
    r = random.Random(3)
    texts = ["".join(r.choice("ab.@-_%+12340 ()é") for _ in range(r.randint(0, 40))) for _ in range(20_000)] + ["4111 1111 1111 1111", "+1 (555) 010-9999", "1.2.3.4.5", "x@y.zz@w.vv", "1" * 5000 + ".2.3.4"]
    for t in texts:
        assert pii.detect(t) == pii_reference(t), t


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("write john [at] mail (dot) example.com now", "email", "john [at] mail (dot) example.com"),
        ("ann dot lee at mail dot org ok", "email", "ann dot lee at mail dot org"),
        ("my ｊoe@ｍail.com", "email", "ｊoe@ｍail.com"),
        ("jо​hn@example.com", "email", "jо​hn@example.com"),
        ("call plus four nine one five one two three four five six seven", "phone", "plus four nine one five one two three four five six seven"),
        ("ip one nine two dot one six eight dot one dot two", "ip", "one nine two dot one six eight dot one dot two"),
        ("card 4111 1111 one one one one 1111", "card", "4111 1111 one one one one 1111"),
    ],
)
def test_disguises_map_back_to_source_characters(text, kind, span):
    base, every = pii.spans(text)
    assert (kind, text.index(span), text.index(span) + len(span)) in every and set(base) <= set(every)
    assert pii.batch_spans(pa.array([text]))[0] == (base, every)


@pytest.mark.parametrize("text", ["five of them at the end. the point is", "un deux trois", "look at this dot", "one two", "a [b] (c) {d}", "été à 12 h"])
def test_plain_prose_has_no_spans(text):
    assert pii.spans(text) == ([], [])


def test_rewriting_keeps_the_source_of_every_character():
    r = pii.Rewritten("abcdef")
    r.apply([(1, 3, "X"), (4, 5, "")])
    r.apply([(0, 2, "YZ")])
    assert r.text == "YZdf" and [r.source(i, i + 1) for i in range(4)] == [(0, 3), (0, 3), (3, 4), (5, 6)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_pii_on_odd_tables(spark, odd, empty):
    more = odd.unionByName(odd.limit(1).withColumn("doc_id", F.lit(500).cast("long")).withColumn("text", F.lit("x@y.zz ip 1.2.3.4 [at]")))
    rows = dict(ids_texts(more))
    for r in pii.find(more).collect():
        if r.doc_id in (500, 10):
            want = pii_reference(rows[r.doc_id])
            assert (r.n_email, r.n_ip, r.base_sha256) == (sum(k == "email" for k, _, _ in want), sum(k == "ip" for k, _, _ in want), digest(want))
    assert pii.find(more).count() == more.count() and pii.find(empty).count() == 0
    out = pii.redact(more)
    assert out.columns == more.columns and {r.doc_id: (r.text, r.n_chars) for r in out.collect()}[500] == ("[EMAIL] ip [IP] [at]", 20)
    assert sorted((r.text or "" for r in out.collect() if r.doc_id != 500)) == sorted(t or "" for i, t in ids_texts(odd))


def obfuscated(r, address):
    at, dot = r.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" {AT} ", "."), (" <at> ", " <dot> "), (" at ", " dot ")])
    if dot == ".":
        return address.replace("@", at)
    return address.replace("@", at).replace(".", dot)


def test_planted_disguises_are_found():
    r = random.Random(12)
    digit = ["zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun"]
    glyph = {"a": "а", "e": "е", "o": "ｏ", "c": "с", "1": "１", "0": "𝟎"}
    caught = total = 0
    for _ in range(400):
        kind = r.choice(["email", "email", "ip", "phone", "card"])
        if kind == "email":
            plain = f"{r.choice(WORDS)}{r.randint(1, 99)}@{r.choice(WORDS)}.example.org"
            shown = obfuscated(r, plain) if r.random() < 0.6 else "".join(glyph.get(c, c) for c in plain).replace("@", "\u200b@")
        else:
            number = {"ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)), "phone": lambda: "+" + "".join(str(r.randint(1, 9)) for _ in range(11)), "card": lambda: r.choice(["4111111111111111", "5500005555555559"])}[kind]()
            names = r.choice(digit).split()
            words = [names[int(c)] if c.isdigit() else "plus" if c == "+" else "dot" for c in number]
            shown = " ".join(words) if r.random() < 0.6 else "".join(chr(0xFF10 + int(c)) if c.isdigit() else c for c in number)
        text = f"{prose(6, r.random())} {shown} , {prose(6, r.random())}"
        a = text.index(shown)
        total += 1
        caught += any(k == kind and s <= a and e >= a + len(shown) for k, s, e in pii.spans(text)[1])
    assert caught / total >= 0.9, caught / total


def test_long_texts_take_linear_time():
    import time

    began = time.time()
    for text in (" " * 1_000_000, "[" + " " * 1_000_000, "a at" + " " * 1_000_000 + "b dot c", "[at] " * 50_000 + " ", "x@y.zz (dot) " * 50_000, "one " * 200_000):
        pii.spans(text)
    assert pii.spans("a" + " " * 99_999 + "[at]" + " " * 99_999 + "b.cc")[1] == [("email", 0, 200_007)]
    for text in ("token=abcdef12 " * 50_000, "a8Fz91kLmQ0pXv73TtRw2B " * 20_000, "token=a8Fz91kLmQ0pXv73TtRw2B " * 20_000):
        secret_scan.spans(text)
    assert time.time() - began < 120


# ---- secrets ----

ASSIGN = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + """|[aA][pP][iI]_?[kK][eE][yY])["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_reference(t):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(found, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def test_secret_base_spans_against_the_patterns():
    r = random.Random(2)
    parts = ["token", "ToKen ", "api_key", "APIKEY", ":", "=", '"', "'", " ", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "passwd", "xyz.", "ſecret=", "é", "\n"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert secret_scan.spans(t)[0] == secret_reference(t), t
        assert secret_scan.batch_spans(pa.array([t]))[0] == secret_scan.spans(t), t


def entropy(s):
    return -sum(c / len(s) * np.log2(c / len(s)) for c in collections.Counter(s).values())


def test_windows_against_recounted_entropy():
    r = random.Random(6)
    for _ in range(300):
        s = "".join(r.choice(r.choice(["0123456789abcdef", "abcXYZ0189+/", "ab1"])) for _ in range(r.randint(20, 60)))
        hot = set()
        for i in range(len(s) - 19):
            w = s[i : i + 20]
            up, low, dig = (sum(f(c) for c in w) for f in (str.isupper, str.islower, str.isdigit))
            kind = "hex" if all(c in "0123456789abcdefABCDEF" for c in w) and not (up and low) else "mixed" if up and low else "lower" if dig >= 3 else ""
            if dig >= 2 and up + low and kind and entropy(w) >= secret_scan.THRESHOLDS[kind] - 1e-9:
                hot.add((i, i + 20))
        got = secret_scan.windows(s)
        assert all(any(a <= x and y <= b for a, b in got) for x, y in hot)
        assert {a for a, _ in got} <= {a for a, _ in hot} and {b for _, b in got} <= {b for _, b in hot}


def test_entropy_spans_and_allow_list():
    found = lambda t: [t[a:b] for k, a, b in secret_scan.spans(t)[1] if k == "entropy"]
    assert found("key a8Fz91kLmQ0pXv73TtRw2B end") == ["a8Fz91kLmQ0pXv73TtRw2B"]
    for t in ("550e8400-e29b-41d4-a716-446655440000", "2024-01-01-2025-02-02-2026", "a-very-long-name-with-words-12", "abcdefghijklmnopqrstuvwxyz0123", "sha256: 9F86D081884C7D659A2FEAA0C55AD015", "thisisonlyaverylongwordwithoutdigits"):
        assert found(t) == []


def test_undeclared_keys_are_found():
    r = random.Random(21)
    caught = total = false = 0
    for _ in range(600):
        alphabet = r.choice(["0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])
        key = "".join(r.choice(alphabet) for _ in range(r.randint(28, 48)))
        text = f"{prose(8, r.random())} {key} {prose(8, r.random())}"
        a = text.index(key)
        total += 1
        caught += any(s < a + len(key) and e > a for _, s, e in secret_scan.spans(text)[1])
        false += len(secret_scan.spans(prose(200, r.random()))[1])
    assert caught / total >= 0.9 and not false, caught / total


def test_secrets_on_odd_tables(odd, empty):
    got = secret_scan.find(odd)
    assert got.count() == odd.count() and got.where("n_assign + n_access + n_hex > 0 or spans <> ''").count() == 0
    assert got.select("base_sha256").distinct().first()[0] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.find(empty).count() == 0


# ---- sharding ----


def test_sharding_balances_bytes_and_keeps_equal_texts(spark):
    r = random.Random(8)
    rows = [(i, prose(r.randint(1, 60), i % 700), "en", "s", 0) for i in range(1500)] + [(2000 + i, "hot " * 40, "en", "s", 0) for i in range(1500)]
    got = slot_sharding.shard(spark.createDataFrame(rows, SCHEMA)).collect()
    size, shard = collections.Counter(), collections.defaultdict(set)
    for x in got:
        size[x.shard] += x.size
    assert set(size) == set(range(16)) and max(size.values()) < 1.02 * min(size.values())
    texts = {r[0]: r[1] for r in rows}
    for x in got:
        assert x.size == len(texts[x.doc_id].encode()) + 1 and x.text_crc32 == zlib.crc32(texts[x.doc_id].encode())
        shard[texts[x.doc_id]].add(x.shard)
    assert sum(len(v) > 1 for v in shard.values()) == 1  # only the group that is larger than half a shard
    for k in size:
        assert sorted(x.slot for x in got if x.shard == k) == list(range(sum(x.shard == k for x in got)))


def test_slot_map_versions():
    r = random.Random(9)
    size = [r.randint(0, 1000) for _ in range(4096)]
    first = slot_sharding.SlotMap.first()
    second = first.rebalanced(size)
    load = lambda m: [sum(b for b, o in zip(size, m.owner, strict=True) if o == k) for k in range(m.shards)]
    assert second.version == 2 and max(load(second)) - min(load(second)) <= 1e-4 * sum(size) / 16 + 2
    assert second.rebalanced(size).owner == second.owner
    third = second.grown(size)
    moved = [(a, b) for a, b in zip(second.owner, third.owner, strict=True) if a != b]
    assert {b for _, b in moved} == {16} and abs(load(third)[16] / (sum(size) / 17) - 1) < 0.05


def test_the_stored_map_is_loaded_and_edited(spark, tmp_path):
    folder, moved, before = str(tmp_path / "map"), [], None
    for run, n in enumerate((2000, 2400, 2900)):
        docs = spark.createDataFrame([(i, prose(20 + i % 30, i)) for i in range(n)], "doc_id long, text string")
        rows = slot_sharding.shard(docs, folder=folder).collect()
        assert {r.map_version for r in rows} == {run + 2}
        size = collections.Counter()
        for r in rows:
            size[r.shard] += r.size
        assert max(size.values()) < 1.05 * min(size.values())
        current = slot_sharding.SlotMap.load(spark, folder)
        if before is not None:
            moved.append(sum(a != b for a, b in zip(before.owner, current.owner, strict=True)))
        before = current
    assert max(moved) < 400  # of 4096 slots; a map made anew would move most
    rows = slot_sharding.shard(docs, shards=17, folder=folder).collect()
    assert {r.shard for r in rows} == set(range(17)) and {r.map_version for r in rows} == {6}
    with pytest.raises(ValueError, match="shards"):
        slot_sharding.shard(docs, shards=3, folder=folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        before.store(spark, folder)


def test_groups_of_equal_texts_stay_whole_up_to_a_shard(spark):
    rows = [(i, prose(40, i)) for i in range(1500)] + [(2000 + i, prose(40, -1)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = slot_sharding.shard(docs).where("doc_id >= 2000").select("shard", "spread").distinct().collect()
    assert len(got) == 1 and not got[0].spread  # about 0.8 of a shard
    assert slot_sharding.shard(docs, whole=0.3).where("doc_id >= 2000 and spread").select("shard").distinct().count() > 1


def test_sharding_on_odd_tables(spark, odd, empty, tmp_path):
    got = slot_sharding.shard(odd, folder=str(tmp_path / "map"))
    assert got.count() == odd.count() and got.where("law = 'bytes' and grown_shard is null and shard between 0 and 15").count() == odd.count()
    assert spark.read.parquet(str(tmp_path / "map/version=2")).count() == 4096
    assert slot_sharding.shard(empty).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- packing and token counts ----


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


def test_packing_round_trip(odd, empty):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    tool = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in ids_texts(odd):
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += collections.Counter((i, a, min(2048, len(ids) - a), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids)) for a in range(0, len(ids), 2048))
    got = packing.pack(odd, path).collect()
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at <= 2048
    assert packing.pack(empty, path).count() == 0


def test_more_distinct_pieces_than_places(spark):
    from tokenizers import Tokenizer

    from corroba.llm._pieces import Encoder, Table

    path = vocabulary("byte_bpe_50k.json")
    tool, r = Encoder(path, held=100), random.Random(0)
    tool.table = Table(4)
    whole = Tokenizer.from_file(path)
    for _ in range(3):
        texts = [" ".join("".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(5000)), "short"]
        ids, bounds = tool.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    with pytest.raises(ValueError, match="byte-level"):
        Encoder(vocabulary("word_bpe_49k.json"))


def test_neighbours_on_the_curve_share_sequences(odd):
    """Sequences hold neighbours of the curve: within a partition, a block's sequences come before the next block's."""
    rows = packing.encoded(odd, vocabulary("byte_bpe_50k.json"), "doc_id", "text", 2048).collect()
    keys = {}
    for x in rows:
        keys.setdefault(x.doc_id, set()).add(x.key)
    want = packing.curve_keys(pa.array([t for _, t in ids_texts(odd)], pa.string()))
    for (i, _), k in zip(ids_texts(odd), want.tolist(), strict=True):
        assert k in keys[i]


def test_copies_are_packed_side_by_side():
    column = pa.array([prose(100, 1), prose(100, 2), prose(100, 1), None, ""])
    keys = packing.curve_keys(column)
    assert keys[0] == keys[2] != keys[1] and keys[3] == keys[4]


@pytest.mark.parametrize("hot", [5, 100_000])
def test_token_counts(odd, empty, hot):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in ids_texts(odd):
        n = len(tool.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 2048] += 1
    got = token_counts.token_counts(odd, path, hot=hot).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert token_counts.token_counts(empty, path).count() == 0


# ---- quality rules ----


def statistics_reference(t):
    w = re.findall("[^\x20\x09-\x0d]+", t or "")
    times, marked = collections.Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if times[w[k], w[k + 1], w[k + 2]] > 1:
            marked |= {k, k + 1, k + 2}
    lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(marked)


def test_statistics_against_plain_python(spark, odd, empty, labels):
    r = random.Random(1)
    noise = spark.createDataFrame([(i, "".join(r.choice(["a ", "b ", "c", "#", "|", "\n", "\t", "é ", " "]) for _ in range(r.randint(0, 90)))) for i in range(300)], "doc_id long, text string")
    for df in (noise, odd):
        want = collections.Counter((i, *statistics_reference(t)) for i, t in ids_texts(df))
        got = quality_rules.judge(df, labels)
        assert collections.Counter(tuple(x) for x in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()) == want
        for x in got.collect():
            assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words) and not (x.base_failed and x.kept)
    assert quality_rules.judge(empty, labels).count() == 0
    assert quality_rules.judge(odd, labels.where("false")).where("not base_failed and not kept").count() == 0
    assert not re.search("Python|Arrow|Pandas", quality_rules.judge(odd, labels)._jdf.queryExecution().executedPlan().toString())


def test_rules_find_the_bad_rows_that_are_held_out(spark):
    docs, known = quality_tables(spark, 800)
    out = quality_rules.judge(docs, known).join(known, "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    assert out and np.mean([x.kept == bool(x.quality) for x in out]) > 0.97


def test_covering_stops_where_rules_are_not_precise():
    grid = {"symbols": (0.01, 0.02, 0.3), "n_words": (5.0,)}
    none = dict.fromkeys(grid, 0)
    mixed = [(none, (50.0, 25.0), (50.0, 25.0))]
    assert quality_rules.learn(mixed, grid) == []
    clear = [(none | {"symbols": 3}, (40.0, 20.0), (0.0, 0.0)), (none, (0.0, 0.0), (40.0, 20.0))]
    assert [[str(c) for c in rule] for rule in quality_rules.learn(clear, grid)] == [["symbols >= 0.01"]]


@pytest.mark.parametrize("n", [120, 400])
def test_labels_of_both_kinds_yield_rules_also_where_they_are_few(spark, n):
    docs, known = quality_tables(spark, n)
    stats = quality_rules.statistics(docs)
    rules = quality_rules.rules_of(stats, known)
    assert rules
    # the query's verdict against the list read in plain Python
    ratio = lambda a, b: a / max(b, 1)
    rows = {}
    for r in stats.collect():
        rows[r.doc_id] = {"n_words": r.n_words, "mean_word": ratio(r.word_chars, r.n_words), "symbols": ratio(r.n_symbols, r.word_chars), "capitals": ratio(r.n_capitals, r.word_chars), "repeated": ratio(r.n_repeat_words, r.n_words), "distinct": ratio(r.n_distinct_words, r.n_words), "dup_lines": ratio(r.n_dup_lines, r.n_lines)}
    for r in quality_rules.judge(docs, known).collect():
        bad = any(all((rows[r.doc_id][c.feature] < c.threshold) == c.below for c in rule) for rule in rules)
        assert r.kept == (not r.base_failed and not bad)


# ---- masked pseudo-likelihood ----


def test_probabilities_add_up_to_one():
    counts = np.random.default_rng(0).integers(0, 50, masked_lm.TOKENS)
    p = masked_lm.fresh(counts)
    pad = masked_lm.TOKENS
    total = sum(float(np.exp(masked_lm.log_likelihoods(p, np.array([pad, pad, x, 70, 900, pad, pad], np.int32), np.array([2]))[0])) for x in range(masked_lm.TOKENS))
    assert abs(total - 1) < 1e-3


def test_gradient_steps_raise_the_likelihood():
    r = np.random.default_rng(1)
    tokens = np.tile(np.array([3, 70, 900, 5], np.int32), 400)
    at = np.arange(2, len(tokens) - 2)
    p = masked_lm.fresh(np.bincount(tokens, minlength=masked_lm.TOKENS))
    before = masked_lm.log_likelihoods(p, tokens, at).mean()
    model = masked_lm.Trainer(p)
    for _ in range(30):
        model.learn(tokens, r.permutation(at)[:512])
    assert masked_lm.log_likelihoods(model.p, tokens, at).mean() > before + 0.5
    assert np.allclose(masked_lm.flat(masked_lm.shaped(masked_lm.flat(p))), masked_lm.flat(p))


def test_words_are_counted_over_the_whole_corpus(odd):
    words, counts = masked_lm.vocabulary(odd)
    want = collections.Counter(w for _, t in ids_texts(odd) for w in fold(t).encode().split())
    assert counts.sum() == sum(want.values())
    assert sorted(counts[: len(words.hashes)].tolist(), reverse=True) == sorted(want.values(), reverse=True)[: len(words.hashes)]


def test_pseudo_likelihood_on_odd_tables(odd, empty):
    got = masked_lm.pseudo_likelihood(odd)
    rows = collections.Counter((r.doc_id, r.n_tokens) for r in got.collect())
    assert rows == collections.Counter((i, len(fold(t).encode().split())) for i, t in ids_texts(odd))
    for r in got.collect():
        assert (r.mean_log_likelihood is None and r.log_likelihood == 0) if r.n_tokens == 0 else r.log_likelihood < 0
    assert masked_lm.pseudo_likelihood(empty).count() == 0


def test_context_is_learned_from_both_sides(spark):
    r = random.Random(3)
    pairs = [("red", "fox"), ("blue", "sea"), ("old", "oak"), ("hot", "sun")]
    text = lambda n: " ".join(f"{a} x {b}" for a, b in (r.choice(pairs) for _ in range(n)))
    docs = spark.createDataFrame([(i, text(400)) for i in range(40)], "doc_id long, text string")
    words, p, logs = masked_lm.fit(docs, stride=1)
    swapped = " ".join("red x sea blue x oak old x sun hot x fox".split() * 20)
    test = spark.createDataFrame([(0, text(80)), (1, swapped)], "doc_id long, text string")
    good, bad = (x.mean_log_likelihood for x in masked_lm.score(test, words, p, logs).orderBy("doc_id").collect())
    assert good > bad + 0.3


def plain_likelihood(text, known, p, logs):
    """Loops over words, neighbours, hidden units, classes and bytes."""
    m = masked_lm
    words = fold(text).encode().split()
    rare = lambda h: m.TOKENS - m.RARE + h % m.RARE
    hashes = [int(next(T.words(pa.array([w.decode()]))).hashes()[0]) for w in words]
    tokens = [known.get(h, rare(h)) for h in hashes]
    total = 0.0
    for i, t in enumerate(tokens):
        h = p["b"].astype(float).copy()
        for k, step in enumerate((-2, -1, 1, 2)):
            h += p["E"][k][tokens[i + step] if 0 <= i + step < len(tokens) else m.TOKENS]
        h = [max(x, 0.0) for x in h]
        log_softmax = lambda x: x - np.log(np.exp(x).sum())
        total += log_softmax(np.array([sum(a * b for a, b in zip(h, p["Wc"][:, c], strict=True)) + p["bc"][c] for c in range(m.CLASSES)]))[t // m.CLASS]
        total += log_softmax(np.array([sum(a * b for a, b in zip(h, p["Wo"][t // m.CLASS][x], strict=True)) + p["bo"][t // m.CLASS][x] for x in range(m.CLASS)]))[t % m.CLASS]
        if hashes[i] not in known:
            path = [m.EDGE, *words[i], m.EDGE]
            total += np.log(m.RARE) + sum(logs[a, b] for a, b in zip(path, path[1:], strict=False))
    return total


def test_likelihoods_against_plain_loops(spark):
    texts = [prose(60, 70 + i) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words, p, _ = masked_lm.fit(docs, rounds=1)
    words = masked_lm.Vocabulary(words.hashes[:150])  # the others are rare
    spelling, counts = masked_lm.Spelling(), collections.Counter()
    known = {int(h): k for k, h in enumerate(words.hashes)}
    for w in T.words(pa.array(texts)):
        spelling.add(w, words.tokens(w.hashes()) >= masked_lm.TOKENS - masked_lm.RARE)
    for t in texts:
        for x in t.encode().split():
            if int(next(T.words(pa.array([x.decode()]))).hashes()[0]) not in known:
                counts.update(zip([256, *x], [*x, 256], strict=True))
    assert {(a, b): int(spelling.counts[a, b]) for a, b in zip(*np.nonzero(spelling.counts), strict=True)} == counts
    ten = [prose(12, 900 + i) for i in range(7)] + ["Neverseen wörd", "", prose(3, 71)]
    got = masked_lm.score(spark.createDataFrame(list(enumerate(ten)), "doc_id long, text string"), words, p, spelling.logs()).collect()
    for r in got:
        assert abs(r.log_likelihood - plain_likelihood(ten[r.doc_id], known, p, spelling.logs())) < 1e-3


def test_rounds_shuffle_as_many_models_as_tasks(spark):
    docs = spark.createDataFrame([(i, prose(30, i)) for i in range(200)], "doc_id long, text string").repartition(40)
    words, counts = masked_lm.vocabulary(docs)
    model = (masked_lm.fresh(counts), masked_lm.fresh_sums(), masked_lm.Spelling())
    one = masked_lm.train_round(docs, "text", words, model, 0, 1, 1, 1)
    many = masked_lm.train_round(docs, "text", words, model, 0, 1, 1, 3)
    assert not np.allclose(one[0]["Wo"], many[0]["Wo"])  # the average depends on the number of tasks
    assert all((one[1][k] >= model[1][k] - 1e-9).all() for k in one[1])  # squared gradients are carried on
    import pickle

    assert len(pickle.dumps(words)) < 10 * len(words.hashes) + 1000
    assert np.array_equal(pickle.loads(pickle.dumps(words)).known, words.known)
