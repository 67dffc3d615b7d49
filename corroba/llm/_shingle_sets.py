"""Distinct shingles of texts as sets: which pairs of sets have a Jaccard similarity of 0.8 or more.

Used by ``simhash_dedup.keep_one`` to verify links of the trie join and to find those beyond its radius.

1. Prefix filter: two sets with similarity 0.8 share a shingle among the first ``n - ceil(0.8 n) + 1`` of each in
   any common order. The order puts shingles that are frequent in a sample of the texts last, so buckets are
   small; the sample decides their sizes only, never the result. Buckets of equal members are one.
2. Candidates of a bucket must pass two bounds that no similar pair fails: the ratio of sizes, and the distance of
   parity sketches, which is never more than the sets' difference. They are verified on the whole sets.
   Equal texts of a task send their shingles once. Shingles that ``HOT`` or more texts of the sample hold are dealt
   by salts, so the members of the bucket of a third of all texts are found by many tasks.
   A bucket of more than ``PART`` members is compared in tiles, one for each two of its parts, so that no task holds
   all of it; every pair of members meets in one tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._frames import map_arrow, written

SHINGLE = 5
SKETCH = 256  # bits of the shortest sketch
SAMPLE = 8192  # texts that the order of shingles is taken from
COMMON = 1 << 17  # shingles that the order puts last, the most frequent of the sample
ROWS = 1 << 17
PAIRS = 1 << 18  # pairs of a bucket that are compared at a time
HOT = 8  # a power of two: texts of the sample from which the members of a shingle's bucket are found by ``SALTS`` tasks
SALTS = 64
PART = 512  # members from which a bucket is divided into parts, whose pairs of parts are compared in separate tasks


def _sets(column: pa.Array):
    """(first row, number of rows, shingles, begin) of each block: every text's distinct shingles, sorted."""
    for w in T.words(column):
        h, begin = T.shingle_hashes(w.hashes(), w, SHINGLE)
        doc = np.repeat(np.arange(w.n_docs), np.diff(begin))
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        yield w.first, w.n_docs, h, np.searchsorted(doc, np.arange(w.n_docs + 1))


def _names(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hash of each set; 0 for the empty one."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(T.mix(h ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    return total[begin[1:]] - total[begin[:-1]]


def _places(n: np.ndarray) -> np.ndarray:
    """Bits of the sketch of a set of ``n`` shingles: a power of two from ``SKETCH`` on, at least ``n``."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(n, SKETCH))).astype(np.int64))


def _sketches(h: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Bits of each set: whether an odd number of its shingles fall into a place."""
    size = _places(np.diff(begin))
    start = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(size)), np.diff(begin))
    at = start[doc] + (h & (size[doc] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=int(size.sum())) & 1).astype(np.uint8))
    return [odd[a // 8 : (a + m) // 8].tobytes() for a, m in zip(start, size, strict=True)]


def _apart(sketch: list[bytes], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the sketches of the pairs i, j differ; the longer sketch is folded onto the shorter."""
    out = np.zeros(len(i), np.int64)
    size = _places(n)
    pair = np.minimum(size[i], size[j])
    for m in np.unique(pair):
        on = np.flatnonzero(pair == m)
        used = np.unique(np.concatenate([i[on], j[on]]))
        bits = np.zeros((len(used), m // 64), np.uint64)
        for k in np.unique(size[used]):
            rows = np.flatnonzero(size[used] == k)
            whole = np.frombuffer(b"".join(sketch[x] for x in used[rows]), np.uint64).reshape(len(rows), k // m, m // 64)
            bits[rows] = np.bitwise_xor.reduce(whole, axis=1)
        step = max(1, (1 << 25) // int(m))
        for k in range(0, len(on), step):
            x, y = (np.searchsorted(used, v[on[k : k + step]]) for v in (i, j))
            out[on[k : k + step]] = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
    return out


def texts_of(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, fp (the set's name), n (distinct shingles), sim (64-bit SimHash of the set) and sketch of each row."""

    def make():
        def step(batch: pa.RecordBatch):
            for first, n, h, begin in _sets(batch.column(len(keys))):
                kept = [batch.column(i).slice(first, n) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(_names(h, begin).view(np.int64)), pa.array(np.diff(begin), pa.int64()), pa.array(T.majority_bits(h, begin).view(np.int64)), pa.array(_sketches(h, begin), pa.binary())], [*keys, "fp", "n", "sim", "sketch"])

        return step

    kinds = dict(docs.dtypes)
    return map_arrow(docs, [*keys, text], ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", fp bigint, n bigint, sim bigint, sketch binary", make)


def common_shingles(docs: DataFrame, rows: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that the order puts last, sorted, and their level; from about ``SAMPLE`` texts."""
    part = docs.where(F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 20)) < max(1, min(1 << 20, (SAMPLE << 20) // max(rows, 1))))

    def make():
        def step(batch: pa.RecordBatch):
            for _, _, h, _ in _sets(batch.column(0)):
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

        return step

    counted = map_arrow(part, [text], "h bigint, n bigint", make).groupBy("h").agg(F.sum("n").alias("n"))
    top = counted.where("n > 1").orderBy(F.desc("n"), "h").limit(COMMON).toPandas()
    h = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.log2(top["n"].to_numpy(np.float64)[order]).astype(np.int64) + 1


def prefixes(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], text: str) -> DataFrame:
    """(bucket, salt, fp): the shingles of each text's prefix, once for the equal texts of a task; the salt is -1 unless the shingle is hot."""
    last, level = common

    def make():
        seen: set[int] = set()

        def step(batch: pa.RecordBatch):
            for _, _, h, begin in _sets(batch.column(0)):
                name = _names(h, begin)
                first = np.zeros(len(name), bool)
                for k, x in enumerate(name.tolist()):
                    if x not in seen:
                        seen.add(x)
                        first[k] = True
                size = np.diff(begin)
                doc = np.repeat(np.arange(len(size)), size)
                rank = np.zeros(len(h), np.int64)
                if len(last):
                    at = np.minimum(np.searchsorted(last, h), len(last) - 1)
                    rank = np.where(last[at] == h, level[at], 0)
                order = np.lexsort((h, rank, doc))
                on = (np.arange(len(h)) - begin[:-1][doc] < (size - (-(-4 * size // 5)) + 1)[doc]) & first[doc]
                fp, hot = name[doc[on]], rank[order][on] >= HOT.bit_length()
                salt = np.where(hot, (T.mix(fp) % np.uint64(SALTS)).astype(np.int8), np.int8(-1))
                yield pa.RecordBatch.from_arrays([pa.array(h[order][on].view(np.int64)), pa.array(salt, pa.int8()), pa.array(fp.view(np.int64))], ["bucket", "salt", "fp"])

        return step

    return map_arrow(docs, [text], "bucket bigint, salt tinyint, fp bigint", make)


def _by_bucket(rows: DataFrame, columns: list[str], schema: str, solve, keys: int = 1) -> DataFrame:
    """``solve`` over blocks of whole buckets, sorted by them; the first ``keys`` columns tell buckets apart."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        held: list[pa.RecordBatch] = []
        size = 0

        def taken() -> pa.RecordBatch:
            nonlocal size
            size = 0
            out = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            return out

        def step(batch: pa.RecordBatch):
            nonlocal size
            if not batch.num_rows:
                return
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS and any(held[0].column(k)[0] != batch.column(k)[-1] for k in range(keys)):
                whole = taken()
                other = np.zeros(whole.num_rows, bool)
                for k in range(keys):
                    key = whole.column(k).to_numpy()
                    other |= key != key[-1]
                cut = int(np.flatnonzero(other)[-1]) + 1
                held.append(whole.slice(cut))
                size = whole.num_rows - cut
                yield from solve(whole.slice(0, cut))

        def finish():
            if held:
                yield from solve(taken())

        step.finish = finish
        return step

    return map_arrow(rows.select(*columns).repartition(n, *columns[:keys]).sortWithinPartitions(*columns[:keys]), columns, schema, make)


def _shared(block: pa.RecordBatch):
    """(bucket, salt, fp, members, mark) of the buckets with two members or more, each member once; of a hot bucket its salts' parts, of any size."""
    bucket, salt, fp = (block.column(k).to_numpy() for k in range(3))
    order = np.lexsort((fp, salt, bucket))
    bucket, salt, fp = bucket[order], salt[order], fp[order]
    edge = np.ones(len(fp), bool)
    edge[1:] = (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])
    new = edge.copy()
    new[1:] |= fp[1:] != fp[:-1]
    bucket, salt, fp, first = bucket[new], salt[new], fp[new], np.flatnonzero(edge[new])
    size = np.diff(np.append(first, len(bucket)))
    mark = np.bitwise_xor.reduceat(T.mix(fp.view(np.uint64)), first).view(np.int64)
    # buckets of equal members are one, here within the task
    chosen = salt[first] >= 0
    many = np.flatnonzero((size > 1) & ~chosen)
    chosen[many[np.unique(np.stack([size[many], mark[many]]), axis=1, return_index=True)[1]]] = True
    on = np.repeat(chosen, size)
    if on.any():
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[on], salt[on], fp[on], np.repeat(size, size)[on], np.repeat(mark, size)[on])], ["bucket", "salt", "fp", "members", "mark"])


def buckets(prefix_rows: DataFrame) -> DataFrame:
    """(bucket, fp, members): one bucket for each set of two or more texts that share a prefix shingle."""
    key = ["bucket", "salt"]
    rows = written(_by_bucket(prefix_rows, [*key, "fp"], "bucket bigint, salt tinyint, fp bigint, members bigint, mark bigint", _shared, 2), "shingle-buckets")
    # the parts of a hot bucket share no member, so its size is their sum and its mark their exclusive or
    parts = rows.groupBy(*key).agg(F.first("members").alias("members"), F.first("mark").alias("mark"))
    whole = parts.groupBy("bucket").agg(F.max("salt").alias("salt"), F.sum("members").alias("members"), F.expr("bit_xor(mark)").alias("mark")).where("members > 1")
    one = whole.groupBy("members", "mark").agg(F.min(F.struct("bucket", "salt")).alias("best"))
    salts = F.when(F.col("best.salt") < 0, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    one = one.select("best.bucket", "members", F.explode(salts.cast("array<tinyint>")).alias("salt"))
    return rows.select(*key, "fp").join(one, key).select("bucket", "fp", "members")


def _candidates(turn: str):
    """Pairs (a, b) of different classes of a bucket to verify: for "nearest" each member's closest one, for "all" every one."""

    def solve(block: pa.RecordBatch):
        bucket, fp, n, root, part, other = (block.column(k).to_numpy() for k in range(6))
        sketch = block.column(6).to_pylist()
        edge = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def passed():
            i, j = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            apart = _apart(sketch, n, i, j)
            near = 9 * apart <= n[i] + n[j]
            i, j, apart = i[near], j[near], apart[near]
            if turn == "nearest":
                # rows of a member are never divided between two calls
                order = np.lexsort((fp[j], apart / np.maximum(n[i] + n[j], 1), i))
                i, j = i[order], j[order]
                first = np.ones(len(i), bool)
                first[1:] = i[1:] != i[:-1]
                i, j = i[first], j[first]
            a, b = np.unique(np.stack([np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for at, end in zip(edge[:-1], edge[1:], strict=True):
            step = max(1, PAIRS // (end - at))
            for k in range(at, end, step):
                i, j = (x.ravel() for x in np.meshgrid(np.arange(k, min(end, k + step)), np.arange(at, end), indexing="ij"))
                on = (root[i] != root[j]) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
                on &= (part[i] == other[i]) | (part[i] != part[j])
                if turn == "all":
                    on &= i < j
                if on.any():
                    waiting.append((i[on], j[on]))
                    held += int(on.sum())
                if held > PAIRS:
                    yield from passed()
                    held = 0
        if waiting:
            yield from passed()

    return solve


def _tiles(rows: DataFrame, part: int) -> DataFrame:
    """``rows`` of the buckets with several roots; ``bucket`` is the tile (``part``, ``other``) of a bucket of several parts.

    Buckets are told apart by their rows pre-aggregated, and met by their rows part by part.
    """
    parts = F.ceil(F.col("members") / part)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), parts))
    mixed = rows.groupBy("bucket", "members").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    mixed = mixed.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    rows = rows.join(mixed, ["bucket", "part"], "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    tile = F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other"))
    return rows.withColumn("bucket", F.when(parts > 1, tile).otherwise(F.col("bucket")))


def candidates(members: DataFrame, roots: DataFrame, turn: str, part: int = PART) -> DataFrame:
    """Pairs (a, b) of ``members`` (bucket, fp, members, n, sketch) that may be similar and are of different ``roots`` (fp, root)."""
    rows = _tiles(members.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), part)
    return _by_bucket(rows, ["bucket", "fp", "n", "root", "part", "other", "sketch"], "a bigint, b bigint", _candidates(turn)).distinct()


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets (fp, grams) have a similarity of 0.8 or more."""
    both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("fp").alias("b"), F.col("grams").alias("y")), "b")
    counted = both.select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return counted.where("5 * shared >= 4 * (n - shared)").select("a", "b")


def whole_sets(docs: DataFrame, text: str) -> DataFrame:
    """(fp, grams): the set of each row, its shingles sorted."""

    def make():
        def step(batch: pa.RecordBatch):
            for _, _, h, begin in _sets(batch.column(0)):
                grams = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_names(h, begin).view(np.int64)), grams], ["fp", "grams"])

        return step

    return map_arrow(docs, [text], "fp bigint, grams array<bigint>", make)
