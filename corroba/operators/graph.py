"""Graph operators over edges (relationship_id, source_entity_id, target_entity_id, relationship_type, weight)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

S, T = "source_entity_id", "target_entity_id"


def pair_key(a: str = S, b: str = T) -> tuple[Column, Column]:
    """Unordered endpoints: smaller, larger."""
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def undirected(edges: DataFrame) -> DataFrame:
    """(node, neighbour) for both directions of each edge, self-loops once; other columns kept."""
    both = F.explode(F.when(F.col(S) == F.col(T), F.array(F.struct(F.col(S).alias("node"), F.col(T).alias("neighbour")))).otherwise(F.array(F.struct(F.col(S).alias("node"), F.col(T).alias("neighbour")), F.struct(F.col(T).alias("node"), F.col(S).alias("neighbour")))))
    return edges.withColumn("__e", both).select("__e.node", "__e.neighbour", *(c for c in edges.columns if c not in (S, T)))


def prominence(edges: DataFrame) -> DataFrame:
    """(canonical_id, prominence): edge rows at both ends; a self-loop counts twice."""
    return edges.select(F.explode(F.array(S, T)).alias("canonical_id")).groupBy("canonical_id").agg(F.count("*").alias("prominence"))


def incident_edges(edges: DataFrame) -> DataFrame:
    """(canonical_id, n_edges): edge rows that touch a node; a self-loop counts once.

    Stands for joins on ``source = id OR target = id``, which would be nested loops.
    """
    return edges.select(F.explode(F.array_distinct(F.array(S, T))).alias("canonical_id"), "relationship_id").groupBy("canonical_id").agg(F.count_distinct("relationship_id").alias("n_edges"))


def with_incident_edges(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """``entities`` with ``n_edges``; entities without edges have 0."""
    return entities.join(incident_edges(edges), "canonical_id", "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))


def simple_graph(edges: DataFrame) -> DataFrame:
    """(a, b, weight): one undirected edge per pair, weights summed (a missing weight is 1), no self-loops."""
    return edges.where(F.col(S) != F.col(T)).groupBy(*pair_key()).agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("weight"))


def existing_relationship(pairs: DataFrame, edges: DataFrame, match_type: bool = True) -> DataFrame:
    """``pairs`` (a, b[, relationship_type]) with the smallest ``relationship_id`` of that pair, in either direction."""
    keys = ["a", "b", *(["relationship_type"] if match_type else [])]
    found = edges.select(*pair_key(), *(keys[2:]), "relationship_id").groupBy(*keys).agg(F.min("relationship_id").alias("relationship_id"))
    return pairs.join(found, keys, "left")


def top_connected(entities: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` entities with the highest prominence; ties by id."""
    return entities.join(prominence(edges), "canonical_id").orderBy(F.desc("prominence"), "canonical_id").limit(n)


def build_graph(entities: DataFrame, edges: DataFrame, min_connections: int = 5, noise: Column | None = None, excluded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (canonical_id, canonical_name) with enough edge rows that are neither noise nor excluded, and their simple graph."""
    nodes = entities.join(prominence(edges).where(F.col("prominence") >= min_connections), "canonical_id")
    if noise is not None:
        nodes = nodes.where(~noise)
    if excluded is not None:
        nodes = nodes.join(excluded, "canonical_id", "left_anti")
    nodes = nodes.select("canonical_id", "canonical_name", "prominence")
    ids = nodes.select("canonical_id")
    kept = edges.join(ids.withColumnRenamed("canonical_id", S), S, "left_semi").join(ids.withColumnRenamed("canonical_id", T), T, "left_semi")
    return nodes, simple_graph(kept)


def degrees(graph: DataFrame) -> DataFrame:
    """(node, degree) of a simple graph."""
    return graph.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def neighbours(graph: DataFrame) -> DataFrame:
    """(node, neighbour) in both directions of a simple graph."""
    return graph.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour")), F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour")))).alias("e")).select("e.node", "e.neighbour")


def common_neighbour_gaps(graph: DataFrame, top_nodes: int = 200, min_common: int = 3, top_n: int = 500, names: int = 10) -> DataFrame:
    """Pairs among the best connected nodes with no edge but ``min_common`` shared neighbours or more.

    Only the neighbours of the ``top_nodes`` nodes meet, so a neighbour meets at most that many.
    """
    degree = degrees(graph)
    top = degree.orderBy(F.desc("degree"), "node").limit(top_nodes)
    near = neighbours(graph).join(F.broadcast(top), "node")  # top_nodes rows
    left = near.select("neighbour", F.col("node").alias("a"), F.col("degree").alias("degree_a"))
    right = near.select("neighbour", F.col("node").alias("b"), F.col("degree").alias("degree_b"))
    shared = left.join(right, "neighbour").where("a < b").groupBy("a", "b", "degree_a", "degree_b")
    found = shared.agg(F.count("*").alias("common_neighbours")).where(F.col("common_neighbours") >= min_common)
    open_ = found.join(graph.select("a", "b"), ["a", "b"], "left_anti")
    score = (F.col("common_neighbours") * (F.col("degree_a") + F.col("degree_b"))).alias("priority_score")
    best = open_.select("a", "b", "common_neighbours", "degree_a", "degree_b", score).orderBy(F.desc("priority_score"), "a", "b").limit(top_n)
    # names only for the pairs that are reported; the first few of each by their rank
    told = left.join(right, "neighbour").join(F.broadcast(best.select("a", "b")), ["a", "b"])
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("neighbour"))
    sample = told.select("a", "b", "neighbour").withColumn("r", rank).where(F.col("r") <= names).groupBy("a", "b").agg(F.sort_array(F.collect_list("neighbour")).alias("sample"))
    return best.join(sample, ["a", "b"]).orderBy(F.desc("priority_score"), "a", "b")


def jaccard(graph: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the Jaccard similarity of their neighbour sets, by joins on the neighbour."""
    near, degree = neighbours(graph), degrees(graph)
    shared = pairs.join(near.select(F.col("node").alias("x"), "neighbour"), "x").join(near.select(F.col("node").alias("y"), "neighbour"), ["y", "neighbour"]).groupBy("x", "y").agg(F.count("*").alias("shared"))
    out = pairs.join(shared, ["x", "y"], "left").join(degree.select(F.col("node").alias("x"), F.col("degree").alias("dx")), "x", "left").join(degree.select(F.col("node").alias("y"), F.col("degree").alias("dy")), "y", "left")
    n = F.coalesce("shared", F.lit(0))
    union = F.coalesce("dx", F.lit(0)) + F.coalesce("dy", F.lit(0)) - n
    return out.select(*pairs.columns, n.alias("shared"), F.when(union > 0, n / union).otherwise(0.0).alias("jaccard"))


def _routed(bounds: np.ndarray):
    """Lists (node, near), each to the block of its node and, as a question, to the blocks of its greater neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, near = batch.column(0).to_numpy(), batch.column(1)
            values, starts = near.values.to_numpy(), near.offsets.to_numpy()
            sizes = np.diff(starts)
            row = np.repeat(np.arange(len(nodes)), sizes)
            z = values[starts[0] : starts[-1]]
            asked = z > nodes[row]
            to = np.unique(row[asked] * (len(bounds) + 1) + np.searchsorted(bounds, z[asked], "right"))
            rows = np.concatenate([np.arange(len(nodes)), to // (len(bounds) + 1)])
            block = np.concatenate([np.searchsorted(bounds, nodes, "right"), to % (len(bounds) + 1)])
            asks = np.arange(len(rows)) >= len(nodes)
            for at in range(0, len(rows), 4096):
                part = slice(at, at + 4096)
                yield pa.RecordBatch.from_arrays([pa.array(block[part].astype("int32")), pa.array(asks[part]), pa.array(nodes[rows[part]]), near.take(pa.array(rows[part]))], names=["block", "asks", "node", "near"])

    return run


def _answered(bounds: np.ndarray):
    """(x, y, shared, jaccard) of questions, which follow the lists of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ids = -1, [], None
        for batch in batches:
            blocks, asks, nodes, near = (batch.column(i) for i in range(4))
            blocks, asks, nodes, values, starts = blocks.to_numpy(), asks.to_numpy(zero_copy_only=False), nodes.to_numpy(), near.values.to_numpy(), near.offsets.to_numpy()
            xs, ys, shared, union = [], [], [], []
            for i in range(len(nodes)):
                own = values[starts[i] : starts[i + 1]]
                if blocks[i] != block:
                    block, held, ids = blocks[i], [], None
                if not asks[i]:
                    held.append((nodes[i], own.copy()))
                    continue
                if ids is None:  # all lists of the block are here
                    held.sort(key=lambda e: e[0])
                    ids, sizes = np.array([e[0] for e in held]), np.array([len(e[1]) for e in held])
                    every = np.concatenate([e[1] for e in held])
                    columns, every = np.unique(every, return_inverse=True)
                    ends = np.cumsum(sizes)
                    mark, held = np.zeros(len(columns), bool), []
                own = np.sort(own)
                y = own[(own > nodes[i]) & (np.searchsorted(bounds, own, "right") == block)]
                place = np.minimum(np.searchsorted(columns, own), len(columns) - 1)
                place = place[columns[place] == own]
                mark[place] = True
                at = np.searchsorted(ids, y)
                n, upto = sizes[at], np.cumsum(sizes[at])
                index = np.repeat(ends[at] - upto, n) + np.arange(upto[-1])
                both = np.add.reduceat(mark[every[index]], upto - n, dtype=np.int64)
                mark[place] = False
                xs.append(np.full(len(y), nodes[i]))
                ys.append(y)
                shared.append(both)
                union.append(n + len(own) - both)
            if xs:
                x, y, both, n = (np.concatenate(c) for c in (xs, ys, shared, union))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(both), pa.array(both / n)], names=["x", "y", "shared", "jaccard"])

    return run


def edge_jaccard(graph: DataFrame, materialise, entries: int = 4_000_000) -> DataFrame:
    """(x, y, shared, jaccard) for the ends x < y of every edge of a simple graph whose nodes are whole numbers (long).

    Nodes fall into blocks of neighbouring numbers, with about ``entries`` neighbours in a block. A node's neighbours go
    once to each block that holds some of them, so pairs of edges are never rows: they are counted where the lists meet.
    ``materialise`` writes a frame and returns it read again.
    """
    near = materialise(neighbours(graph).groupBy("node").agg(F.collect_list("neighbour").alias("near")))
    blocks = -(-(near.agg(F.sum(F.size("near"))).first()[0] or 1) // entries)
    cuts = [i / blocks for i in range(1, blocks)]
    bounds = np.unique(np.array(near.agg(F.percentile_approx("node", cuts, 10_000)).first()[0] or [] if cuts else [], dtype="int64"))
    rows = near.mapInArrow(_routed(bounds), "block int, asks boolean, node long, near array<long>")
    rows = rows.repartition(len(bounds) + 1, "block").sortWithinPartitions("block", "asks")
    return rows.mapInArrow(_answered(bounds), "x long, y long, shared long, jaccard double")


def hub_pairs_without_edge(entities: DataFrame, hubs: DataFrame, edges: DataFrame) -> DataFrame:
    """(canonical_id, hub_id) of two bounded sets that no edge of any type connects."""
    pairs = entities.select("canonical_id").crossJoin(F.broadcast(hubs.select(F.col("canonical_id").alias("hub_id")))).where("canonical_id <> hub_id")
    linked = edges.select(*pair_key()).distinct()
    return pairs.withColumn("a", F.least("canonical_id", "hub_id")).withColumn("b", F.greatest("canonical_id", "hub_id")).join(linked, ["a", "b"], "left_anti").select("canonical_id", "hub_id")


def communities(graph: DataFrame, rounds: int = 10, materialise=None) -> DataFrame:
    """(node, community) by local moves that gain modularity: fixed rounds, ties to the smallest label.

    A node compares, for its own community and those of its neighbours, the weight of its edges into it with the
    weight to expect there by the strengths of both. Nodes of every second digest move in a round, which keeps two
    parts from swapping for ever. ``materialise`` cuts the lineage after each round (a function DataFrame -> DataFrame).
    """
    near = graph.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("neighbour"), "weight"), F.struct(F.col("b").alias("node"), F.col("a").alias("neighbour"), "weight"))).alias("e")).select("e.*")
    near = near if materialise is None else materialise(near)
    strength = near.groupBy("node").agg(F.sum("weight").alias("k"))
    total = strength.agg(F.sum("k").alias("m"))  # one row
    labels = strength.select("node", "k", F.col("node").alias("community"))
    for turn in range(rounds):
        held = labels.groupBy("community").agg(F.sum("k").alias("held"))
        into = near.join(labels.select(F.col("node").alias("neighbour"), "community"), "neighbour").select("node", "community", "weight")
        into = into.unionByName(labels.select("node", "community", F.lit(0.0).alias("weight"))).groupBy("node", "community").agg(F.sum("weight").alias("w"))
        own = F.col("community") == F.col("own")
        gain = F.col("w") - F.col("k") * (F.col("held") - F.when(own, F.col("k")).otherwise(0.0)) / F.col("m")
        told = into.join(held, "community").join(labels.select("node", "k", F.col("community").alias("own")), "node").crossJoin(F.broadcast(total))
        best = told.groupBy("node").agg(F.min_by("community", F.struct((-gain).alias("g"), F.col("community"))).alias("best"))
        moves = F.substring(F.md5(F.col("node").cast("string").cast("binary")), 32, 1).isin(*"02468ace") == (turn % 2 == 0)
        labels = labels.join(best, "node").select("node", "k", F.when(moves, F.col("best")).otherwise(F.col("community")).alias("community"))
        if materialise is not None:
            labels = materialise(labels)
    return labels.select("node", "community")


def community_bridges(graph: DataFrame, labels: DataFrame, min_communities: int = 2) -> DataFrame:
    """Nodes whose neighbours are in ``min_communities`` communities or more; score = communities x degree."""
    near = neighbours(graph).join(labels.select(F.col("node").alias("neighbour"), "community"), "neighbour")
    out = near.groupBy("node").agg(F.count_distinct("community").alias("communities_connected"), F.count("*").alias("degree"))
    return out.where(F.col("communities_connected") >= min_communities).withColumn("bridge_score", F.col("communities_connected") * F.col("degree"))


class NeighbourLists:
    """A simple graph with whole numbers (long) for nodes, as one list of neighbours a node, in blocks of nodes.

    ``parts`` makes the lists, of a graph (a, b, weight) or of mentions. A list names neighbours by their places among the
    nodes that its block needs. Lists stay as bytes, and what a round needs of the neighbours goes once to each block that
    has some of them, so edges are never rows. ``name`` is the node's text, whose digest says in which rounds it moves.
    ``materialise`` writes a frame and returns it read again.
    """

    def __init__(self, graph: DataFrame, materialise, name: Column, entries: int = 2_000_000, parts=None):
        self.materialise = materialise
        self.bounds, rows = (edge_parts if parts is None else parts)(graph, materialise, entries)
        even = F.when(F.col("listed"), F.substring(F.md5(name.cast("binary")), 32, 1).isin(*"02468ace"))
        rows = materialise(rows.withColumn("even", even))
        self.lists, self.need = rows.where("listed"), materialise(rows.where("not listed").select("block", "listed", "node"))

    def strengths(self) -> DataFrame:
        return self.lists.select("node", "k", "even")

    def meet(self, state: DataFrame, answer, schema: str, even: bool | None = None) -> DataFrame:
        """``answer`` on the lists, or on those of one digest, and the ``state`` (node, community, held) of their nodes and neighbours."""
        told = self.need.join(state.select("node", "community", "held"), "node")
        rows = self.lists if even is None else self.lists.where(F.col("even") == even)
        rows = told.unionByName(rows.select("block", "listed", "node", "k", "near", "weights"), allowMissingColumns=True)
        return rows.repartitionById(len(self.bounds) + 1, "block").mapInArrow(_met(answer, schema.replace(",", " ").split()[::2]), schema)


_PART = "block int, listed boolean, node long, k double, near binary, weights binary"


def _bounds(entries_at, low: int | None, high: int | None, total: int | None, entries: int) -> np.ndarray:
    """First nodes of all blocks but one. ``entries_at(edges)`` counts entries by ranges of nodes that begin at ``edges``: (at, n)."""
    if not total or total <= entries:
        return np.array([], dtype="int64")
    edges, last, parts = np.array([low]), np.array([high + 1]), 65_536
    heavy = np.array([True])
    while heavy.any():  # ranges with more than a block are divided again, down to single nodes
        cut = [np.arange(a, b, -(-(b - a) // parts)) if h else np.array([a]) for a, b, h in zip(edges.tolist(), last.tolist(), heavy, strict=True)]
        edges, last = np.concatenate(cut), np.r_[np.concatenate(cut)[1:], high + 1]
        n = np.zeros(len(edges), dtype="int64")
        for at, count in entries_at(edges).collect():
            n[at] = count
        heavy = (n > entries) & (last - edges > 1)
        parts = max(2, 65_536 // max(1, int(heavy.sum())))
    block = (np.cumsum(n) - n) // entries
    return edges[np.flatnonzero(block[1:] != block[:-1]) + 1]


def _counted(edges: np.ndarray, read):
    """(at, n) of the nodes and counts that ``read`` finds in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(edges), dtype="int64")
        for batch in batches:
            for nodes, n in read(batch):
                total += np.bincount(np.searchsorted(edges, nodes, "right") - 1, n, len(edges)).astype("int64")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    return run


def _entries_at(df: DataFrame, read):
    return lambda edges: df.mapInArrow(_counted(edges, read), "at long, n long").groupBy("at").agg(F.sum("n"))


def edge_parts(graph: DataFrame, materialise, entries: int) -> tuple[np.ndarray, DataFrame]:
    """Bounds of blocks, and lists and needed nodes of the edges of a simple graph."""
    ends = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("z"), F.col("weight").cast("double"))
    ends = materialise(graph).select(F.explode(F.array(ends("a", "b"), ends("b", "a"))).alias("r")).select("r.*")
    count = _entries_at(ends.select("node"), lambda batch: [(batch.column(0).to_numpy(), None)])
    bounds = _bounds(count, *ends.agg(F.min("node"), F.max("node"), F.count("*")).first(), entries)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(bounds, batch.column(0).to_numpy(), "right").astype("int32")
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], names=["block", "node", "z", "weight"])

    rows = ends.mapInArrow(placed, "block int, node long, z long, weight double").repartitionById(len(bounds) + 1, "block")
    return bounds, rows.mapInArrow(_edges_listed, _PART)


def mention_parts(mentions: DataFrame, materialise, entries: int, doc: Column, node: Column) -> tuple[np.ndarray, DataFrame]:
    """As ``edge_parts``, of the graph whose edges weigh how many ``mentions`` (part, of: long) of two nodes share a doc.

    ``doc`` is made of the part, ``node`` of ``of``; equal mentions count once. A doc's nodes go once to each block that holds
    some of them, and become pairs there.
    """
    docs = mentions.select("part", "of").repartition(doc).select(doc.alias("doc"), "part", "of").sortWithinPartitions("doc")
    docs = docs.select("doc", "part", "of", node.alias("node")).mapInArrow(_docs, "low long, high long, entries long, nodes binary, sizes binary")
    docs = materialise(docs)
    count = _entries_at(docs.select("nodes", "sizes"), lambda batch: ((nodes, np.repeat(sizes - 1, sizes)) for nodes, sizes in _groups([batch])))
    bounds = _bounds(count, *docs.agg(F.min("low"), F.max("high"), F.sum("entries")).first(), entries)
    rows = docs.select("nodes", "sizes").mapInArrow(_docs_routed(bounds), "block int, nodes binary, sizes binary")
    return bounds, rows.repartitionById(len(bounds) + 1, "block").mapInArrow(_docs_listed(bounds), _PART)


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: ``values`` cut at ``ends``, which count from its first."""
    offsets = np.r_[0, ends] * values.itemsize
    kind, width = (pa.binary(), "int32") if offsets[-1] < 1 << 31 else (pa.large_binary(), "int64")
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of binary values, one after another, and their lengths."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], "int64")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", "uint8")[at[0] : at[-1]], np.diff(at)


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts``, one after another."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for nodes, sizes in zip(batch.column("nodes"), batch.column("sizes"), strict=True):
            yield np.frombuffer(nodes.as_buffer(), "int64"), np.frombuffer(sizes.as_buffer(), "int64")


def _docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of docs of two mentions or more, a few hundred thousand a row, from mentions by doc."""

    def made(rows):
        at = np.cumsum(np.r_[False, rows[0, 1:] != rows[0, :-1]])
        low, span = int(rows[2].min()), int(rows[2].max()) - int(rows[2].min()) + 1
        one = ((rows[1, 1:] == rows[1, :-1]) | (at[1:] != at[:-1])).all()  # a part a doc
        if one and span * (int(at[-1]) + 1) < 1 << 62:
            order = _order(at * span + (rows[2] - low), span * (int(at[-1]) + 1))
        else:
            order = np.lexsort((rows[2], rows[1], at))
        rows = rows[:, order]
        fresh = np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]
        doc, nodes = rows[0, fresh], rows[3, fresh]
        sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)])
        nodes, sizes = nodes[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
        if len(sizes):
            values = [int(nodes.min()), int(nodes.max()), int((sizes * (sizes - 1)).sum()), nodes.tobytes(), sizes.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["low", "high", "entries", "nodes", "sizes"])

    held, n = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns]))
        n += held[-1].shape[1]
        if n >= 250_000:
            rows = np.concatenate(held, axis=1)
            cut = np.searchsorted(rows[0], rows[0, -1])  # the last doc may go on
            if cut:
                yield from made(rows[:, :cut])
            held, n = [rows[:, cut:]], 0
    if held:
        yield from made(np.concatenate(held, axis=1))


def _docs_routed(bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, sizes in _groups(batches):
            block = np.searchsorted(bounds, nodes, "right")
            to = np.unique(block * len(sizes) + np.repeat(np.arange(len(sizes)), sizes))
            block, doc = to // len(sizes), to % len(sizes)
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            starts = np.cumsum(sizes) - sizes
            moved, ends = nodes[_gathered(starts[doc], sizes[doc])], np.cumsum(sizes[doc])
            last = np.r_[first[1:], len(to)]
            yield pa.RecordBatch.from_arrays([pa.array(block[first].astype("int32")), _bytes(moved, ends[last - 1]), _bytes(sizes[doc], last)], names=["block", "nodes", "sizes"])

    return run


def _docs_listed(bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = 0, []
        for batch in batches:
            block = batch.column("block")[0].as_py()
            held.extend((nodes.copy(), sizes.copy()) for nodes, sizes in _groups([batch]))
        if not held:
            return
        nodes, sizes = (np.concatenate(c) for c in zip(*held, strict=True))
        need, place = np.unique(nodes, return_inverse=True)
        own = np.flatnonzero(np.searchsorted(bounds, need, "right") == block)
        first, end = own[0], own[-1] + 1
        doc = np.repeat(np.arange(len(sizes)), sizes)
        ours = np.flatnonzero((place >= first) & (place < end))
        n = sizes[doc[ours]]
        key = np.repeat(place[ours] * len(need), n)
        key += place[_gathered((np.cumsum(sizes) - sizes)[doc[ours]], n)]
        del doc, ours, n, nodes, sizes, place
        key = np.sort(key[key // len(need) != key % len(need)])
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        yield from _parts(block, need, key[at], np.diff(np.r_[at, len(key)]).astype("float64"))

    return run


def _edges_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        node, z, w = (table.column(c).to_numpy() for c in ("node", "z", "weight"))
        need, place = np.unique(np.concatenate([node, z]), return_inverse=True)
        key = place[: len(node)] * len(need) + place[len(node) :]
        order = np.argsort(key)
        yield from _parts(table.column("block")[0].as_py(), need, key[order], w[order])


def _parts(block: int, need: np.ndarray, key: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Lists and needed nodes of a block, from ascending pairs of places (node's * count + neighbour's) and their weights."""
    if not len(key):
        return
    own, near = key // len(need), key % len(need)
    used = np.zeros(len(need), bool)
    used[own] = used[near] = True
    near = (np.cumsum(used) - 1)[near].astype("int32")
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    nodes, k, ends = need[own[first]], np.add.reduceat(w, first), np.r_[first[1:], len(own)]
    if (small := w.astype("uint8")).astype("float64").tobytes() == w.tobytes():  # most weights are small counts
        w = small
    for i in range(0, len(nodes), 4096):
        e = ends[i : i + 4096]
        part = slice(first[i], e[-1])
        n, cut = len(e), e - first[i]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, "int32")), pa.array(np.ones(n, bool)), pa.array(nodes[i : i + 4096]), pa.array(k[i : i + 4096]), _bytes(near[part], cut), _bytes(w[part], cut)], names=["block", "listed", "node", "k", "near", "weights"])
    z = need[used]
    none = lambda kind: pa.nulls(len(z), kind)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(z), block, "int32")), pa.array(np.zeros(len(z), bool)), pa.array(z), none(pa.float64()), none(pa.binary()), none(pa.binary())], names=["block", "listed", "node", "k", "near", "weights"])


def _met(answer, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, lists = [], []
        for batch in batches:
            listed = batch.column("listed")
            lists.append(batch.filter(listed).select(["node", "k", "near", "weights"]))
            batch = batch.filter(pc.invert(listed))
            told.append([batch.column(c).to_numpy() for c in ("node", "community", "held")])
        if not told:
            return
        node, community, held = (np.concatenate(c) for c in zip(*told, strict=True))
        order = np.argsort(node)
        node = node[order]
        known, first, rank = np.unique(community[order], return_index=True, return_inverse=True)
        held = held[order][first]
        for part in lists:
            if part.num_rows:
                nodes, k, (near, sizes), (weights, _) = part.column("node").to_numpy(), part.column("k").to_numpy(), _values(part.column("near")), _values(part.column("weights"))
                near, sizes = near.view("int32"), sizes // 4
                weights = weights if len(weights) == len(near) else weights.view("float64")
                ends, own, out = np.cumsum(sizes), rank[np.searchsorted(node, nodes)], []
                cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(65_536, ends[-1], 65_536)), len(nodes)])
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):  # what fits a core's cache
                    at = slice(ends[i] - sizes[i], ends[j - 1])
                    out.append(answer(nodes[i:j], k[i:j], sizes[i:j], own[i:j], rank[near[at]], weights[at], known, held))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=columns)

    return run


def _order(key: np.ndarray, limit: int) -> np.ndarray:
    """The stable order of keys from 0 to below ``limit``: where it fits, one sort of numbers that hold key and place."""
    bits = len(key).bit_length()
    if limit.bit_length() + bits < 64:
        return np.sort((key << bits) | np.arange(len(key))) & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


def _summed(key: np.ndarray, w: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``limit``, ascending, and the sums of their weights in the order given."""
    order = _order(key, limit)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(w[order], first)


def _moving(total: float):
    """A node's best community by gain, then the smallest."""

    def answer(nodes, k, sizes, own, near, weights, known, held):
        n, m = len(nodes), len(known)
        rows = np.arange(n) * m
        key, w = _summed(np.concatenate([np.repeat(rows, sizes) + near, rows + own]), np.concatenate([weights, np.zeros(n)]), n * m)
        row, c = key // m, key % m
        mine = k[row]
        gain = w - mine * (held[c] - np.where(c == own[row], mine, 0.0)) / total
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        top = np.flatnonzero(gain == np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.r_[starts, len(row)])))
        return nodes, k, known[c[top[np.r_[True, row[top][1:] != row[top][:-1]]]]]  # communities ascend within a row

    return answer


def _bridging(nodes, k, sizes, own, near, weights, known, held):
    n, m = len(nodes), len(known)
    key = np.sort(np.repeat(np.arange(n) * m, sizes) + near)
    return nodes, np.bincount(key[np.r_[True, key[1:] != key[:-1]]] // m, minlength=n), sizes


def _with_held(labels: DataFrame) -> DataFrame:
    return labels.join(labels.groupBy("community").agg(F.sum("k").alias("held")), "community")


def list_communities(lists: NeighbourLists, rounds: int = 10) -> DataFrame:
    """(node, k, even, community): the rounds of ``communities`` over neighbour lists."""
    labels = lists.materialise(lists.strengths().withColumn("community", F.col("node")))
    total = labels.agg(F.sum("k")).first()[0] or 0.0
    for turn in range(rounds):
        even = turn % 2 == 0  # only the lists of nodes that may move are read
        moved = lists.meet(_with_held(labels), _moving(total), "node long, k double, community long", even)
        labels = lists.materialise(moved.withColumn("even", F.lit(even)).unionByName(labels.where(F.col("even") != even)))
    return labels


def list_bridges(lists: NeighbourLists, labels: DataFrame, min_communities: int = 2) -> DataFrame:
    """``community_bridges`` over neighbour lists."""
    out = lists.meet(labels.withColumn("held", F.lit(0.0)), _bridging, "node long, communities_connected long, degree long")
    return out.where(F.col("communities_connected") >= min_communities).withColumn("bridge_score", F.col("communities_connected") * F.col("degree"))
