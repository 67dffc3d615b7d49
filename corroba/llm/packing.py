"""Packing documents into fixed-length sequences in the order of a space-filling curve.

Steps
-----
1. One pass over the texts: token ids (each distinct piece is encoded once per worker), the CRC of
   every full sequence and of the rest, and the document's Hilbert key: word counts hashed into
   ``BUCKETS`` dimensions, scaled to unit length, projected to ``DIMENSIONS`` normal directions,
   each mapped to its rank, quantised, and read along the curve. Ids are not kept.
2. The light rows are range-sorted by (key, id, CRC), so equal keys (copies) still divide.
3. A document's full sequences stand alone; rests are packed whole with their neighbours on the
   curve: best fit, longest first, inside blocks of ``BLOCK_DOCS`` neighbours. Sequences with room left
   stay open for the next block of the partition.
4. Sequence ids are gapless: each partition's count (a row per partition) gives its first id.

Defined results: a null or empty text is its closing id alone; null and repeated ids are packed row
by row; a document longer than a sequence spans several; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T
from ._frames import map_arrow, written
from ._pieces import Encoder

LENGTH = 2048
CLOSING_ID = 1
BUCKETS = 1024
DIMENSIONS = 4
BITS = 12
BLOCK_DOCS = 4096
OPEN = 512


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each path and process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer points (n, d) with coordinates under 2^bits.

    The curve is built by undoing, from the highest bit down, the exchange or inversion of the
    lower bits of the first axis in each cell, and reading the Gray code of what remains.
    """
    x = points.astype(np.int64).copy()
    n, d = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            here = (x[:, i] & q) != 0
            swap = np.where(here, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(here, low, swap)
            if i:
                x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    carry = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        carry ^= np.where(x[:, d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= carry[:, None]
    key = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | x[:, i] >> bit & 1
    return key


def curve_keys(column: pa.Array, seed: int = 7) -> np.ndarray:
    """Hilbert key of each text's projected hashed word vector."""
    to = np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros(len(column), np.int64)
    for w in T.words(column):
        bucket = (w.hashes() >> np.uint64(54)).astype(np.int64)
        counts = np.bincount(w.doc * BUCKETS + bucket, minlength=w.n_docs * BUCKETS).reshape(w.n_docs, BUCKETS).astype(np.float32)
        size = np.sqrt((counts * counts).sum(1, keepdims=True))
        z = counts @ to / np.maximum(size, 1)
        rank = 1 / (1 + np.exp(-1.702 * z))
        out[w.first : w.first + w.n_docs] = hilbert_keys(np.minimum((rank * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))
    return out


def encoded(docs: DataFrame, path: str, id: str, text: str, length: int) -> DataFrame:
    """id, key, doc_tokens, CRC of each full sequence, CRC of the rest (null if there is none)."""

    def make():
        tool = encoder(path)

        def step(batch: pa.RecordBatch):
            _, at = T.texts(batch.column(1))
            for i, j in T.blocks(at):
                part = batch.slice(i, j - i)
                tokens, full, rest = [], [], []
                every, bounds = tool.encode([x or "" for x in part.column(1).to_pylist()])
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    ids = every[a:b].astype("<u4").tobytes() + CLOSING_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    tokens.append(n)
                    full.append([zlib.crc32(ids[4 * length * k : 4 * length * (k + 1)]) for k in range(n // length)])
                    rest.append(zlib.crc32(ids[4 * length * (n // length) :]) if n % length else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(curve_keys(part.column(1))), pa.array(tokens, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int64())], [id, "key", "doc_tokens", "full", "rest"])

        return step

    return map_arrow(docs, [id, text], f"`{id}` {dict(docs.dtypes)[id]}, key bigint, doc_tokens bigint, full array<bigint>, rest bigint", make)


class Packer:
    """Places lengths into sequences: best fit, longest first in a block; roomy sequences stay open."""

    def __init__(self, length: int):
        self.length, self.used = length, 0
        self.open: list[tuple[int, int]] = []  # (room, sequence), ascending

    def alone(self) -> int:
        self.used += 1
        return self.used - 1

    def place(self, lengths: list[int]) -> list[tuple[int, int]]:
        """(sequence, offset) of each length."""
        out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            need = lengths[i]
            at = bisect.bisect_left(self.open, (need, -1))
            room, sequence = self.open.pop(at) if at < len(self.open) else (self.length, self.alone())
            out[i] = (sequence, self.length - room)
            if room > need:
                bisect.insort(self.open, (room - need, sequence))
        del self.open[: max(0, len(self.open) - OPEN)]
        return out


def pack(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = dict(docs.dtypes)[id]
    light = written(encoded(docs, path, id, text, length), "packing-encoded")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", id, "rest", "doc_tokens"]
    along = light.repartitionByRange(n, *order).sortWithinPartitions(*order)
    names = [id, "start", "length", "ids_crc32", "doc_tokens", "part", "sequence", "offset"]

    def make():
        packer, part = Packer(length), TaskContext.get().partitionId()

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                here = batch.slice(at, BLOCK_DOCS)
                ids, tokens, full, rest = (here.column(i).to_pylist() for i in range(4))
                with_rest = [i for i, x in enumerate(rest) if x is not None]
                placed = dict(zip(with_rest, packer.place([tokens[i] % length for i in with_rest]), strict=True))
                rows = []
                for i, (doc, n_tokens) in enumerate(zip(ids, tokens, strict=True)):
                    rows += [(doc, k * length, length, crc, n_tokens, part, packer.alone(), 0) for k, crc in enumerate(full[i])]
                    if i in placed:
                        rows.append((doc, n_tokens - n_tokens % length, n_tokens % length, rest[i], n_tokens, part, *placed[i]))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], here.schema.field(0).type), *(pa.array(c, pa.int64()) for c in columns[1:])], names)

        return step

    pieces = written(map_arrow(along, [id, "doc_tokens", "full", "rest"], f"`{id}` {kind}, " + ", ".join(f"{x} bigint" for x in names[1:]), make), "packing-pieces")
    # one row per partition
    counts = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("n"))
    first = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return pieces.join(F.broadcast(first), "part").select(*names[:5], (F.col("first") + F.col("sequence")).alias("sequence_id"), "offset")
