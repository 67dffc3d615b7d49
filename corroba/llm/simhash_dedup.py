"""SimHash near-duplicate detection by a binary trie self-join.

Steps
-----
1. Fingerprints: a vectorised pass over whole texts (``fingerprints``); rows are then reduced to
   one per distinct fingerprint, so exact copies never meet in a join.
2. Buckets: two fingerprints that differ in at most ``radius`` bits agree in one of ``radius + 1``
   disjoint blocks of bits, so each is sent to one bucket per block. A bucket above ``bucket_rows``
   is divided again in the same way over the bits that are still free. Nothing is dropped.
3. Trie self-join inside a bucket (``trie_links``): pairs of trie nodes are traversed together, the
   bits in which they differ are summed on the way down, and a pair is pruned as soon as the sum
   passes the radius or both subtrees are known to belong to one component. A bucket returns a
   spanning forest of its links, never all pairs.
4. Components by alternating large-star and small-star steps on written edge tables.

``keep_one`` keeps one row of each group of texts that are linked at a five-word shingle similarity of 0.8. A
64-bit fingerprint cannot tell that exactly: such pairs differ in about ten bits, and no radius that holds them
all prunes a trie. So the trie join unites the copies that are close, each link verified on the whole shingle
sets, and the links beyond its radius come from a prefix filter (``_shingle_sets``), among classes that are still
apart: first each member's nearest candidate, twice, then every candidate that is left.

Defined results: null or blank texts have fingerprint zero and are linked like any other; a null
``doc_id`` takes part but never names a component (null if a component has no other) and is kept only there;
repeated rows are all returned by ``near_duplicates``, and one is kept; fewer words than a shingle's are one
shingle; an empty table gives no rows; further columns are ignored, or kept as they are by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shingle_sets as S
from . import _text as T
from ._frames import discard, fresh_name, map_arrow, written

RADIUS = 4
SHINGLE = 4
BUCKET_ROWS = 4096
LEVELS = 3
CHUNK = 1 << 18
SALTS = 8
NEAREST = 2  # turns in which each member of a bucket offers its nearest candidate only


def fingerprint_batch(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text of a string column."""
    out = np.zeros(len(column), np.uint64)
    for w in T.words(column):
        data, start, end = w.joined()
        first, last, begin = T.shingles(w, shingle)
        out[w.first : w.first + w.n_docs] = T.majority_bits(T.xxh64(data, start[first], end[last]), begin)
    return out


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint's bits as a signed long) of each row."""

    def make():
        def step(batch: pa.RecordBatch):
            fp = fingerprint_batch(batch.column(len(keys)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array(fp)], [*keys, "fp"])

        return step

    kinds = dict(docs.dtypes)
    return map_arrow(docs, [*keys, text], ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", fp bigint", make)


# ---- trie self-join ---------------------------------------------------------------------------


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b; a label is the smallest index of its component."""
    while len(a):
        ra, rb = label[a], label[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        label = _roots(label)
    return label


def trie_links(bucket: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Component label of each fingerprint, linked within its bucket at up to ``radius`` differing bits.

    ``bucket`` and ``fp`` (uint64) are sorted by both; fingerprints are distinct in a bucket. A node
    of the tries is a range of positions, its depth the number of leading bits that the range shares.
    """
    n = len(fp)
    label = np.arange(n)
    if n < 2:
        return label
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    stop = np.concatenate([edge[1:], [n]])
    ones: list[np.ndarray] = []
    for depth in range(64):
        total = np.zeros(n + 1, np.int32)
        np.cumsum((fp >> np.uint64(63 - depth)) & np.uint64(1), out=total[1:], dtype=np.int32)
        ones.append(total)
    # a tight first pass joins dense clusters cheaply, so the full radius finds most of them united
    for budget in (radius // 2, radius) if int((stop - edge).max()) > 512 else (radius,):
        stack = [(0, edge, stop, edge, stop, np.zeros(len(edge), np.int8))]
        while stack:
            depth, al, ah, bl, bh, diff = stack.pop()
            if len(al) > CHUNK:
                half = len(al) // 2
                stack.append((depth, al[:half], ah[:half], bl[:half], bh[:half], diff[:half]))
                al, ah, bl, bh, diff = al[half:], ah[half:], bl[half:], bh[half:], diff[half:]
                stack.append((depth, al, ah, bl, bh, diff))
                continue
            change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
            one = (label[al] == label[bl]) & (change[ah - 1] == change[al]) & (change[bh - 1] == change[bl])
            live = ~one & ((al != bl) | (ah - al > 1))
            leaf = live & ((ah - al) * (bh - bl) <= 16)
            if leaf.any():
                a, b, c, d = al[leaf], ah[leaf], bl[leaf], bh[leaf]
                size = (b - a) * (d - c)
                owner = np.repeat(np.arange(len(a)), size)
                k = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                i, j = a[owner] + k // (d - c)[owner], c[owner] + k % (d - c)[owner]
                near = (i != j) & (np.bitwise_count(fp[i] ^ fp[j]) <= budget)
                label = _unite(label, i[near], j[near])
            live &= ~leaf
            if not live.any():
                continue
            al, ah, bl, bh, diff = al[live], ah[live], bl[live], bh[live], diff[live]
            total = ones[depth]
            am, bm = ah - (total[ah] - total[al]), bh - (total[bh] - total[bl])
            same = al == bl
            pairs = [(al, am, bl, bm, diff, None), (am, ah, bm, bh, diff, None), (al, am, bm, bh, diff + np.int8(1), None), (am, ah, bl, bm, diff + np.int8(1), ~same)]
            kept = []
            for x0, x1, y0, y1, d, only in pairs:
                on = (x1 > x0) & (y1 > y0) & (d <= budget)
                if only is not None:
                    on &= only
                kept.append((x0[on], x1[on], y0[on], y1[on], d[on]))
            stack.append((depth + 1, *(np.concatenate(x) for x in zip(*kept, strict=True))))
    return label


def _trie_edges(buckets: DataFrame, radius: int) -> DataFrame:
    """Spanning forest (a, b) of the links inside each bucket; a bucket is in one partition, and sorted."""
    batch_rows = 1 << 17

    def make():
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def solve(bucket: np.ndarray, fp: np.ndarray):
            label = trie_links(bucket, fp, radius)
            on = np.flatnonzero(label != np.arange(len(label)))
            if len(on):
                yield pa.RecordBatch.from_arrays([pa.array(fp[on].view(np.int64)), pa.array(fp[label[on]].view(np.int64))], ["a", "b"])

        def joined() -> tuple[np.ndarray, np.ndarray]:
            bucket, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((fp, bucket))
            return bucket[order], fp[order]

        def step(batch: pa.RecordBatch):
            held.append((batch.column(0).to_numpy(zero_copy_only=False).copy(), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64).copy()))
            if sum(len(x) for x, _ in held) >= batch_rows and held[-1][0][-1] != held[0][0][0]:
                bucket, fp = joined()
                cut = int(np.searchsorted(bucket, bucket[-1]))
                held.append((bucket[cut:], fp[cut:]))
                yield from solve(bucket[:cut], fp[:cut])

        def finish():
            if held:
                yield from solve(*joined())

        step.finish = finish
        return step

    return map_arrow(buckets, ["bucket", "fp"], "a bigint, b bigint", make)


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[i * len(bits) // parts : (i + 1) * len(bits) // parts] for i in range(parts)]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def near_links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS, levels: int = LEVELS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``) within ``radius`` bits of each other.

    Level by level: rows in buckets of up to ``bucket_rows`` go to the trie join; larger buckets are
    divided again over their free bits, and after ``levels`` levels joined as they are.
    """
    spark = distinct.sparkSession
    # a path names the blocks chosen so far; its free bits are all others
    frontier: list[tuple[str, list[int]]] = [("", list(range(64)))]
    rows = distinct.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("bucket"))
    links: DataFrame | None = None
    for level in range(levels):
        choices, following = [], []
        for path, free in frontier:
            for i, block in enumerate(_blocks(free, radius + 1)):
                choices.append((path, f"{path}{i}", _mask(block)))
                following.append((f"{path}{i}", [b for b in free if b not in block]))
        frontier = following
        by_path: dict[str, list] = {}
        for path, name, mask in choices:
            by_path.setdefault(path, []).append(F.struct(F.lit(name).alias("path"), F.lit(mask).alias("mask")))
        options = F.array() if not by_path else None
        for path, some in by_path.items():
            options = F.array(*some) if options is None else F.when(F.col("path") == path, F.array(*some)).otherwise(options)
        split = rows.select("fp", F.col("bucket").alias("above"), F.explode(options).alias("o")).select(
            "fp", F.col("o.path").alias("path"), F.xxhash64("above", "o.path", F.col("fp").bitwiseAND(F.col("o.mask"))).alias("bucket")
        )
        split = written(split, f"simhash-buckets-{level}")
        if level + 1 < levels:
            large = split.groupBy("bucket").count().where(F.col("count") > bucket_rows).select("bucket")
            large = written(large, f"simhash-large-{level}")
            small = split.join(large, "bucket", "left_anti")
            rows = split.join(large, "bucket", "left_semi")
            more = bool(large.head(1))
        else:
            small, more = split, False
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        packed = (small if more else split).select("bucket", "fp").repartition(n, "bucket").sortWithinPartitions("bucket")
        edges = written(_trie_edges(packed, radius), f"simhash-links-{level}")
        links = edges if links is None else links.unionByName(edges)
        if not more:
            break
    return links.distinct()


# ---- components -------------------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node that has a link; the root is the component's smallest node.

    Alternating large-star and small-star steps. A node's neighbours are only ever reduced to their
    minimum, so a hub is pre-aggregated; each step's edges are written, so lineage stays short.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def classes(base: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root) for each distinct fingerprint of ``base``: its component's smallest fingerprint."""
    distinct = written(base.select("fp").distinct(), "simhash-distinct")
    roots = components(near_links(distinct, radius, bucket_rows))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id of its component)."""
    base = written(fingerprints(docs, [id], text, shingle), "simhash-base")
    first = base.groupBy("fp").agg(F.min(id).alias("low"))
    named = written(first.join(classes(base, radius, bucket_rows), "fp"), "simhash-classes")
    # one row per class, for classes of several fingerprints; a large class is met by its members in parts
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n")).where("n > 1")
    lowest = lowest.select("root", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    parted = named.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    of = parted.join(lowest.withColumn("several", F.lit(True)), ["root", "salt"], "left")
    of = written(of.select("fp", F.when(F.col("several"), F.col("component_id")).otherwise(F.col("low")).alias("component_id")), "simhash-components")
    return base.join(of, "fp").select(id, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def similar_classes(rows: DataFrame, sets: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root) of the sets that are linked: ``rows`` has (row, text), ``sets`` one row (fp, n, sim, sketch, row) per set."""
    # the trie join's links between fingerprints, carried over to one set of each, and sets of one fingerprint
    ends = sets.groupBy("sim").agg(F.min("fp").alias("rep"))
    close = near_links(written(sets.select(F.col("sim").alias("fp")).distinct(), "dedup-fingerprints"), radius, bucket_rows)
    close = close.join(ends.select(F.col("sim").alias("a"), F.col("rep").alias("x")), "a").join(ends.select(F.col("sim").alias("b"), F.col("rep").alias("y")), "b").select("x", "y")
    equal = sets.join(ends, "sim").where("fp <> rep").select(F.col("fp").alias("x"), F.col("rep").alias("y"))
    pairs = close.unionByName(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    members, roots, links, tried = None, None, None, None
    for turn in ("trie", *["nearest"] * NEAREST, "all"):
        if turn != "trie":
            if members is None:
                common = S.common_shingles(rows, rows.count(), "text")
                members = S.buckets(S.prefixes(rows, common, "text"))
                members = written(members.join(sets.select("fp", "n", "sketch"), "fp"), "dedup-members")
            pairs = S.candidates(members, roots, turn).join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "dedup-pairs")
        if turn != "trie" and not pairs.head(1):
            break
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(sets.select("fp", "row"), "fp").select("row")
        grams = written(S.whole_sets(rows.join(wanted, "row", "left_semi"), "text"), "dedup-sets")
        new = written(S.similar(pairs, grams), "dedup-links")
        discard(grams)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        roots = written(components(links).select(F.col("node").alias("fp"), "root"), "dedup-roots")
    discard(members)
    return roots


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the smallest id (nulls last), the first row of equals."""
    row = fresh_name(docs, "row")
    held = written(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    rows = held.select(F.col(row).alias("row"), held[id].alias("id"), held[text].alias("text"))
    base = written(S.texts_of(rows, ["row", "id"], "text"), "dedup-base")
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("best")
    sets = written(base.groupBy("fp").agg(smallest, *(F.first(c).alias(c) for c in ("n", "sim", "sketch"))).withColumn("row", F.col("best.row")), "dedup-distinct")
    discard(base)
    roots = similar_classes(rows, sets)
    of = sets.select("fp", "best").join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    chosen = written(of.select(F.col("best.row").alias(row)), "dedup-chosen")
    return held.join(chosen, row, "left_semi").drop(row)
