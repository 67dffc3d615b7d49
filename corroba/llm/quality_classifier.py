"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Features are hashed into ``2**BITS`` places: single words and pairs of neighbours, of the words as
they stand and of their shapes (letters, capitals and digits collapsed to one character a run), and
pairs of equal neighbours. A feature's value is its share of the text's words. Scores are sparse dot
products over whole texts, summed block by block without a matrix.

Training (``fit``) reads at most ``sample`` labelled rows, those whose hashed ids come first; the
bound is a parameter and the weights' number is fixed. FTRL-proximal updates run in one task over
that bounded sample, ``passes`` times, in the order of the hash.

Defined results: null and empty texts score by the intercept alone; null ids are scored but never learned
from; an id labelled twice counts as its lowest label; repeated rows are scored row by row; without
labels the score is 0.5; an empty table gives no rows; other columns are ignored (``score``) or
kept (``accepted``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._frames import map_arrow, written

BITS = 18
SAMPLE = 8000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
SCALE = 20.0
THRESHOLD = 0.3

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = ord("A"), ord("a"), ord("0"), ord("a")
_RUNS = T.byte_class("Aa0")


def _shapes(w: T.Words) -> np.ndarray:
    """Hash of each word's shape."""
    kind = _SHAPE[w.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != kind[:-1]) | ~_RUNS[kind[1:]]
    keep[w.start] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return T.Words(w.first, w.n_docs, kind[keep], at[w.start], at[w.end], w.begin).hashes()


def _places(w: T.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(documents, feature places) of the block, one pair per family of features."""
    doc, shift = w.doc, np.uint64(64 - BITS)
    out = []
    inside = doc[1:] == doc[:-1]
    for salt, h in ((1, w.hashes()), (2, _shapes(w))):
        one = T.mix(h + np.uint64(salt))
        out.append((doc, (one >> shift).astype(np.int64)))
        pair = T.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] + np.uint64(salt + 10))[inside]
        out.append((doc[1:][inside], (pair >> shift).astype(np.int64)))
        if salt == 1:
            equal = inside & (h[1:] == h[:-1])
            out.append((doc[1:][equal], np.full(int(equal.sum()), 1, np.int64)))
    return out


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Dot product of each text's features with ``weights`` (the last is the intercept)."""
    out = np.full(len(column), weights[-1], np.float64)
    for w in T.words(column, lower=False):
        if not len(w.start):
            continue
        total = np.zeros(w.n_docs)
        for doc, place in _places(w):
            total += np.bincount(doc, weights[place], w.n_docs)
        out[w.first : w.first + w.n_docs] += SCALE * total / np.maximum(w.count, 1)
    return out


def rows_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse features of each text: distinct places and values."""
    out = []
    for w in T.words(column, lower=False):
        doc, place = (np.concatenate(x) for x in zip(*_places(w), strict=True))
        key, n = np.unique(doc * (1 << BITS) + place, return_counts=True)
        edge = np.searchsorted(key, np.arange(w.n_docs + 1) << BITS)
        size = np.maximum(w.count, 1)
        out += [((key[a:b] & ((1 << BITS) - 1)).astype(np.int32), (SCALE * n[a:b] / size[i]).astype(np.float32)) for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True))]
    return out


class Ftrl:
    """Per-coordinate FTRL-proximal state; weights are computed where they are needed."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[at] = more


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", among: Column | None = None, sample: int = SAMPLE, passes: int = PASSES) -> np.ndarray:
    """Weights, with the intercept last. ``among`` restricts the labelled rows that may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known.where(among) if among is not None else known
    known = known.groupBy(id).agg(F.min(label).cast("double").alias("y")).withColumn("turn", F.xxhash64(id))
    known = written(known.orderBy("turn", id).limit(sample), "classifier-sample")
    picked = docs.select(id, text).join(F.broadcast(known), id).groupBy("turn", id, "y").agg(F.min(text).alias(text))

    def make_rows():
        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = rows_of(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([a.tobytes() for a, _ in rows], pa.binary()), pa.array([x.tobytes() for _, x in rows], pa.binary())], ["turn", "y", "places", "shares"])

        return step

    schema = "turn bigint, y double, places binary, shares binary"
    rows = written(map_arrow(picked, ["turn", "y", text], schema, make_rows), "classifier-rows")

    def make_model():
        held: list[tuple[np.ndarray, np.ndarray, float]] = []

        def step(batch: pa.RecordBatch):
            for y, a, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                held.append((np.append(np.frombuffer(a, np.int32), 1 << BITS), np.append(np.frombuffer(x, np.float32), np.float32(1)), y))
            return ()

        def finish():
            model = Ftrl((1 << BITS) + 1)
            for _ in range(passes):
                for at, x, y in held:
                    model.learn(at, x, y)
            w = model.weights(slice(None))
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["place", "weight"])

        step.finish = finish
        return step

    # the sample is bounded, and so is what one task holds
    one = rows.repartition(1).sortWithinPartitions("turn", "y")
    found = map_arrow(one, ["turn", "y", "places", "shares"], "place bigint, weight double", make_model).toPandas()
    weights = np.zeros((1 << BITS) + 1)
    weights[found["place"].to_numpy()] = found["weight"].to_numpy()
    return weights


def _scores(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins(column, weights), -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of each row."""

    def make():
        def step(batch: pa.RecordBatch):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), weights))], [id, "score"])

        return step

    return map_arrow(docs, [id, text], f"`{id}` {dict(docs.dtypes)[id]}, score double", make)


def accepted(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    names, at = docs.columns, docs.columns.index(text)

    def make():
        def step(batch: pa.RecordBatch):
            kept = batch.filter(pa.array(_scores(batch.column(at), weights) >= threshold))
            if kept.num_rows:
                yield pa.RecordBatch.from_arrays(kept.columns, names)

        return step

    return map_arrow(docs, [f"`{n}`" for n in names], ", ".join(f"`{n}` {k}" for n, k in docs.dtypes), make)


def held_out(id: str = "doc_id") -> Column:
    """Every fifth id by its CRC; never learned from. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    weights = fit(docs, labels, id, text, label, among=~held_out(id))
    return score(docs, weights, id, text).select(id, held_out(id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
