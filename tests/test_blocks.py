import itertools
import random
import re
import time
from functools import partial

from pyspark.sql import functions as F

from corroba.operators import graph
from corroba.plans import queries as engine


def test_edge_jaccard_over_blocks(spark, written):
    rng = random.Random(5)
    edges = sorted({tuple(sorted(rng.sample(range(0, 900, 7), 2))) for _ in range(1500)} | {(0, i) for i in range(7, 900, 7)})
    near: dict[int, set[int]] = {}
    for a, b in itertools.chain(edges, ((b, a) for a, b in edges)):
        near.setdefault(a, set()).add(b)
    g = spark.createDataFrame(edges, "a long, b long").withColumn("weight", F.lit(1.0))
    want = sorted((a, b, len(near[a] & near[b]), len(near[a] & near[b]) / len(near[a] | near[b])) for a, b in edges)
    for entries in (300, 100_000):
        assert sorted(tuple(r) for r in graph.edge_jaccard(g, written, entries).collect()) == want
    assert graph.edge_jaccard(g.where("false"), written).count() == 0


def _rings(spark):
    rng = random.Random(6)
    edges = sorted({tuple(sorted((i, (i // 20 * 20 + rng.randrange(20)) if rng.random() < 0.8 else rng.randrange(200)))) for i in range(200) for _ in range(6)})
    return spark.createDataFrame([(a, b, float((a * b) % 5 + 1)) for a, b in edges if a != b], "a long, b long, weight double")


def test_communities_over_blocks(spark, written):
    g = _rings(spark)
    want = sorted(tuple(r) for r in graph.communities(g, materialise=written).collect())
    for entries in (150, 100_000):
        lists = graph.NeighbourLists(g, written, F.col("node").cast("string"), entries)
        assert (len(lists.bounds) > 5) == (entries == 150)
        assert sorted(tuple(r) for r in graph.list_communities(lists).select("node", "community").collect()) == want


def test_bridges_over_blocks(spark, written):
    g = _rings(spark)
    lists = graph.NeighbourLists(g, written, F.col("node").cast("string"), 150)
    labels = graph.list_communities(lists)
    want = sorted(tuple(r) for r in graph.community_bridges(g, labels).select("node", "communities_connected", "degree", "bridge_score").collect())
    assert want
    assert sorted(tuple(r) for r in graph.list_bridges(lists, labels).collect()) == want


def test_written_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_(\d+)_", disk.getAllFiles().mkString(" ")))
    before = shuffles()
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    out = engine._written(counts)
    for _ in range(50):  # they go in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert out.where("count = 100").count() == 10


def test_lists_of_mentions_without_pairs_as_rows(spark, written):
    rng = random.Random(7)
    # long keys are cut like the ids made of them, so docs and items may meet; lines repeat, and one order names one part only
    lines = [(rng.choice([0, 10**8]) * 12 + rng.randrange(40) + 10**7, rng.randrange(90)) for _ in range(300)]
    lines += [(12 * 10**7, 5), (12 * 10**8, 5), (12 * 10**8, 7), (3, 1000), (4, 10**9 + 4), (4, 10**9 + 7), (4, 8), (None, 3), (7, None)]
    lines += lines[:40]
    mentions = {(str(o).rjust(8, "0")[:8], o, p, int(str(p)[:9])) for o, p in lines if o is not None and p is not None}
    pairs: dict[tuple[int, int], float] = {}
    for x, y in itertools.product(mentions, mentions):
        if x[0] == y[0] and x[3] < y[3]:
            pairs[x[3], y[3]] = pairs.get((x[3], y[3]), 0.0) + 1.0
    g = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "a long, b long, weight double")
    rows = spark.createDataFrame(lines, "l_orderkey long, l_partkey long")
    lists = engine._item_lists({"lineitem": rows}.__getitem__)
    name = engine._item("node")
    want = graph.NeighbourLists(g, written, name)
    known = lambda x: sorted((r.node, r.k, r.even) for r in x.strengths().collect())
    assert known(lists) == known(want) and 1000 not in {n for n, _, _ in known(lists)}
    labels = lambda x: sorted((r.node, r.community) for r in graph.list_communities(x).collect())
    assert labels(lists) == labels(want)
    parts = partial(graph.mention_parts, doc=F.substring(F.lpad(F.col("part").cast("string"), 8, "0"), 1, 8).cast("long"), node=F.substring(F.col("of").cast("string"), 1, 9).cast("long"))
    small = graph.NeighbourLists(rows.dropna().toDF("part", "of"), written, name, 200, parts=parts)
    assert len(small.bounds) > 3 and labels(small) == labels(want)
    none = engine._item_lists({"lineitem": rows.where("false")}.__getitem__)
    assert graph.list_bridges(none, graph.list_communities(none, 2)).count() == 0


def test_bridges_take_no_pairs_from_the_loader(spark):
    orders = [(o, p) for o in range(40) for p in {o % 9, o * 7 % 11, o * 5 % 13}]
    asked = []

    def at(name):
        asked.append(name)
        return {"lineitem": spark.createDataFrame(orders, "l_orderkey long, l_partkey long")}[name]

    weights: dict[tuple[int, int], float] = {}
    for o in range(40):
        for pair in itertools.combinations(sorted(p for x, p in orders if x == o), 2):
            weights[pair] = weights.get(pair, 0.0) + 1.0
    g = spark.createDataFrame([(a, b, w) for (a, b), w in weights.items()], "a long, b long, weight double")
    lists = graph.NeighbourLists(g, engine._written, engine._item("node"))
    item = "concat('ITM-', lpad(cast(node as string), 9, '0')) AS node"
    want = graph.community_bridges(g, graph.list_communities(lists)).selectExpr(item, "communities_connected", "degree", "bridge_score")
    got = engine.community_bridges(at).select("node", "communities_connected", "degree", "bridge_score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and asked == ["lineitem"]
