"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

For every benchmark item a window of the item's number of 5-word shingles slides over each text. Windows that
share no shingle with an item cannot be similar to it, so only windows around shared shingles get a
fingerprint; these come from running sums of bits, so each costs the same whatever its size. A
fingerprint is compared through ``BLOCKS`` tables, one for each block of bits: items that differ from it
by at most ``RADIUS`` bits differ by at most ``RADIUS // BLOCKS`` in one block at least, so
none is missed. Candidates within the radius are verified exactly: shared weight over united weight
of their shingles, a shingle's weight being how often it occurs, at ``SIMILARITY`` or more.

The benchmark is handled in blocks of ``ITEMS`` items, each of which the tasks hold; the texts are
scanned once for each block.

Defined results: null, empty or blank texts match nothing, nor do such items; an item or text of fewer
than five words is one shingle of all its words; repeated items and rows are reported each; null ids
are reported as null; an empty table gives no rows; other columns are ignored (``matches``) or kept
(``clean``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._frames import map_arrow

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
ITEMS = 20_000
SPAN = 4096  # positions of a text whose windows are compared at a time


def _near_bytes(radius: int) -> np.ndarray:
    """Which of 256 bytes are within ``radius`` bits of which."""
    byte = np.arange(256, dtype=np.uint8)
    return np.bitwise_count(byte[:, None] ^ byte[None, :]) <= radius


class Index:
    """The items of one block: shingles, fingerprints by window size, and the tables of each size."""

    def __init__(self, texts: list[str | None], ids: list):
        self.ids, self.grams, self.size, owners, found = [], [], [], [], []
        for w in T.words(pa.array(texts, pa.string())):
            h, begin = T.shingle_hashes(w.hashes(), w, SHINGLE)
            for i in range(w.n_docs):
                if begin[i + 1] > begin[i]:
                    grams = h[begin[i] : begin[i + 1]]
                    owners.append(np.full(len(grams), len(self.ids)))
                    found.append(grams)
                    self.ids.append(ids[w.first + i])
                    self.grams.append(np.unique(grams, return_counts=True))
                    self.size.append(len(grams))
        self.size = np.array(self.size, np.int64)
        grams, owners = (np.concatenate(x) if x else np.zeros(0, k) for x, k in ((found, np.uint64), (owners, np.int64)))
        begin = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.fp = T.majority_bits(grams, begin) if len(grams) else np.zeros(0, np.uint64)
        self.gram = np.unique(grams)
        # the window sizes that each shingle asks for, once each however many items share it
        asked = np.unique(np.stack([np.searchsorted(self.gram, grams), self.size[owners]]), axis=1) if len(grams) else np.zeros((2, 0), np.int64)
        self.first, self.asked = np.searchsorted(asked[0], np.arange(len(self.gram) + 1)), asked[1]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.gram >> np.uint64(44)] = True
        near = _near_bytes(RADIUS // BLOCKS)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in np.unique(self.size):
            items = np.flatnonzero(self.size == m)
            blocks = self.fp[items].view(np.uint8).reshape(len(items), BLOCKS)
            self.tables[int(m)] = items, near[:, blocks]  # (256, items, BLOCKS)

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Positions of hashes that are an item's shingle."""
        at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        if not len(self.gram):
            return at[:0]
        return at[self.gram[np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)] == h[at]]

    def search(self, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, float, int]]:
        """(item, similarity, first shingle) of the best window for each item found in a text.

        ``h`` are the text's shingles, ``at`` the positions of those that items have too.
        """
        which = np.searchsorted(self.gram, h[at])
        repeats = self.first[which + 1] - self.first[which]
        where = np.repeat(at, repeats)
        wanted = self.asked[np.repeat(self.first[which] - (np.cumsum(repeats) - repeats), repeats) + np.arange(int(repeats.sum()))]
        n = len(h)
        for m in np.unique(wanted):
            size = min(int(m), n)
            items, table = self.tables[int(m)]
            seen = where[wanted == m]
            mark = np.zeros(n + 2, np.int64)
            np.add.at(mark, np.clip(seen - size + 1, 0, n - size), 1)
            np.add.at(mark, np.minimum(seen, n - size) + 1, -1)
            start = np.flatnonzero(np.cumsum(mark) > 0)
            # windows in runs of positions, so that the sums of bits are held for a stretch of the text only
            for s in np.split(start, np.flatnonzero(np.diff(start // SPAN)) + 1):
                base = int(s[0])
                part = h[base : int(s[-1]) + size]
                bits = ((part[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32)
                sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
                fp = ((2 * (sums[s - base + size] - sums[s - base]) > size).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)
                block = fp.view(np.uint8).reshape(len(s), BLOCKS)
                near = np.zeros((len(s), len(items)), bool)
                for k in range(BLOCKS):
                    near |= table[block[:, k], :, k]
                x, y = np.nonzero(near)
                apart = np.bitwise_count(fp[x] ^ self.fp[items[y]])
                on = apart <= RADIUS
                x, y, apart = x[on], y[on], apart[on]
                for one in np.unique(y):
                    mine = np.flatnonzero(y == one)
                    best, place = 0.0, 0
                    for i in mine[np.lexsort((x[mine], apart[mine]))]:
                        similar = self.similarity(int(items[one]), h[s[x[i]] : s[x[i]] + size])
                        if similar > best:
                            best, place = similar, int(s[x[i]])
                        if best == 1.0:
                            break
                    if best >= SIMILARITY:
                        yield int(items[one]), best, place

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weight that window and item share, over the weight of both together."""
        gram, n = self.grams[item]
        there = gram[np.minimum(np.searchsorted(gram, window), len(gram) - 1)] == window
        own, m = np.unique(window[there], return_counts=True)
        shared = int(np.minimum(n[np.searchsorted(gram, own)], m).sum())
        return shared / (int(n.sum()) + len(window) - shared)


def batch_matches(index: Index, column: pa.Array) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, similarity, first word) of each match in a string column."""
    for w in T.words(column):
        h, begin = T.shingle_hashes(w.hashes(), w, SHINGLE)
        hits = index.hits(h)
        if not len(hits):
            continue
        doc = np.searchsorted(begin, hits, "right") - 1
        for d in np.unique(doc):
            best: dict[int, tuple[float, int]] = {}
            for item, similar, place in index.search(h[begin[d] : begin[d + 1]], hits[doc == d] - begin[d]):
                if item not in best or similar > best[item][0]:
                    best[item] = similar, place
            for item in sorted(best):
                yield w.first + int(d), item, *best[item]


def _blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[tuple[list, list]]:
    """The items' ids and texts, at most about ``ITEMS`` at a time."""
    n = benchmark.count()
    parts = -(-n // ITEMS)
    items = benchmark.select(F.col(id).alias("id"), F.col(text).alias("text"))
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).orderBy("id", "text").collect()
        yield [r.id for r in rows], [r.text for r in rows]


def matches(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each text and item found in it: id, item id, similarity, first word and number of words."""
    kind, item_kind = dict(docs.dtypes)[id], dict(benchmark.dtypes)[item_id]
    schema = f"`{id}` {kind}, `{item_id}` {item_kind}, similarity double, first_word bigint, n_shingles bigint"
    names = [id, item_id, "similarity", "first_word", "n_shingles"]
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark, item_id, item_text):

        def make(ids=ids, texts=texts):
            index = Index(texts, ids)

            def step(batch: pa.RecordBatch):
                found = list(batch_matches(index, batch.column(1)))
                if found:
                    row, item, similar, place = zip(*found, strict=True)
                    kept = pa.array([index.ids[i] for i in item], pa.from_numpy_dtype(np.int64) if item_kind in ("bigint", "int") else None)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), kept, pa.array(similar, pa.float64()), pa.array(place, pa.int64()), pa.array([int(index.size[i]) for i in item], pa.int64())], names)

            return step

        out = out.unionByName(map_arrow(docs, [id, text], schema, make))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found."""
    names, at = docs.columns, docs.columns.index(text)
    schema = ", ".join(f"`{n}` {k}" for n, k in docs.dtypes)
    for ids, texts in _blocks(benchmark, item_id, item_text):

        def make(ids=ids, texts=texts):
            index = Index(texts, ids)

            def step(batch: pa.RecordBatch):
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in batch_matches(index, batch.column(at)):
                    keep[row] = False
                kept = batch.filter(pa.array(keep))
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays(kept.columns, names)

            return step

        docs = map_arrow(docs, [f"`{n}`" for n in names], schema, make)
    return docs
