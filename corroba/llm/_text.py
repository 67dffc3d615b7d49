"""Vectorised work on the bytes of Arrow string columns: words, word hashes, shingles, XXH64.

A word is a run of bytes other than space and \\t..\\r. Texts are handled in blocks of whole
documents of about ``BLOCK`` bytes, so that the intermediate arrays stay in cache and memory is
bounded by the block (or by a single document where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19

U64 = np.uint64
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK * 2)
        have = np.full(size, base, U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser over uint64, so that every bit depends on every bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@dataclass
class Words:
    """Words of the documents ``first`` .. ``first + n_docs - 1`` of a batch, in order."""

    first: int
    n_docs: int
    data: np.ndarray  # bytes of the block
    start: np.ndarray  # of each word in data
    end: np.ndarray
    begin: np.ndarray  # of each document's words; n_docs + 1 entries

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.begin)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, independent of where it stands."""
        if not len(self.start):
            return np.zeros(0, U64)
        power = _power(_BASE, len(self.data))
        total = np.zeros(len(self.data) + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * power, out=total[1:])
        return mix((total[self.end] - total[self.start]) * _power(_BASE_INVERSE, len(self.data))[self.start])

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words joined by single spaces: bytes, starts, ends."""
        size = self.end - self.start
        start = np.cumsum(size + 1) - (size + 1)
        out = np.full(int(size.sum()) + len(size) + 8, 0x20, np.uint8)
        if len(size):
            at = np.repeat(start - self.start, size)
            inside = np.arange(len(at)) + np.repeat(self.start - (np.cumsum(size) - size), size)
            out[at + inside] = self.data[inside]
        return out, start, start + size


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def blocks(at: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``size`` bytes, one document at least."""
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, j
        i = j


def words(column: pa.Array, lower: bool = True, size: int = BLOCK, table: np.ndarray = _WORD) -> Iterator[Words]:
    """The column's words (runs of the bytes in ``table``), block by block; ``lower`` folds A-Z."""
    data, at = texts(column)
    for i, j in blocks(at, size):
        block = data[at[i] : at[j]]
        edge = at[i : j + 1] - at[i]
        inside = table[block]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = edge[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(block))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start = np.flatnonzero(first)
        yield Words(i, j - i, _LOWER[block] if lower else block, start, np.flatnonzero(last) + 1, np.searchsorted(start, edge))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' runs of k words, repeats included; fewer words give one run of all of them.

    Returns the index of each run's first word, of its last word, and each document's first run
    (n_docs + 1 entries).
    """
    count = w.count
    runs = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    begin = np.concatenate([[0], np.cumsum(runs)])
    first = np.arange(begin[-1]) + np.repeat(w.begin[:-1] - begin[:-1], runs)
    return first, first + np.repeat(np.minimum(count, k), runs) - 1, begin


def shingle_hashes(h: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each run of k words, made from the words' hashes, and each document's first run."""
    first, last, begin = shingles(w, k)
    out = h[first] if len(first) else np.zeros(0, U64)
    for step in range(1, k):
        here = first + step
        more = here <= last
        if more.all():
            out = mix(out * U64(0x9E3779B97F4A7C15) + h[here])
        else:
            out = out.copy()
            out[more] = mix(out[more] * U64(0x9E3779B97F4A7C15) + h[here[more]])
    return out, begin


# Fixed values of the XXH64 specification: its five primes.
_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[start:end] for many spans at once. ``data`` needs 8 spare bytes at its end."""
    n, size = len(start), (end - start)
    if not n:
        return np.zeros(0, U64)
    data = np.ascontiguousarray(data)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    four = np.ndarray((len(data) - 3,), "<u4", data, strides=(1,))
    h = np.full(n, seed + int(_P5), U64)
    at = start.copy()
    with np.errstate(over="ignore"):
        long = np.flatnonzero(size >= 32)
        if len(long):
            lanes = [np.full(len(long), (seed + x) % (1 << 64), U64) for x in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
            stripes, here = size[long] // 32, at[long]
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                for i, lane in enumerate(lanes):
                    lane[on] = _turn(lane[on] + eight[here[on] + 32 * k + 8 * i] * _P2, 31) * _P1
            v = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                v = (v ^ (_turn(lane * _P2, 31) * _P1)) * _P1 + _P4
            h[long] = v
            at[long] += 32 * stripes
        h += size.astype(U64)
        rest = size % 32
        for k in range(3):
            on = np.flatnonzero(rest >= 8 * (k + 1))
            if not len(on):
                break
            h[on] = _turn(h[on] ^ (_turn(eight[at[on] + 8 * k] * _P2, 31) * _P1), 27) * _P1 + _P4
        at += rest // 8 * 8
        on = np.flatnonzero(rest & 4)
        if len(on):
            h[on] = _turn(h[on] ^ (four[at[on]].astype(U64) * _P1), 23) * _P2 + _P3
        at += rest & 4
        for k in range(3):
            on = np.flatnonzero((rest & 3) > k)
            if not len(on):
                break
            h[on] = _turn(h[on] ^ (data[at[on] + k].astype(U64) * _P5), 11) * _P1
        h = (h ^ (h >> U64(33))) * _P2
        h = (h ^ (h >> U64(29))) * _P3
        return h ^ (h >> U64(32))


_LANES = U64(0x0001000100010001)


def majority_bits(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each segment of hashes the 64-bit word whose bits are set in over half of them; 0 if it has none."""
    n = len(begin) - 1
    sums = bit_counts(h, begin)
    over = 2 * sums > np.diff(begin)[:, None]
    return (over.astype(U64) << np.arange(64, dtype=U64)).sum(1, dtype=U64) if n else np.zeros(0, U64)


def bit_counts(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many hashes of each segment have each of the 64 bits: (segments, 64).

    Four 16-bit counters share a word, so a segment is summed in parts of 65,535 hashes at most.
    """
    n, size = len(begin) - 1, np.diff(begin)
    out = np.zeros((n, 64), np.int64)
    parts = -(-size // 65535)
    owner = np.repeat(np.arange(n), parts)
    if not len(owner):
        return out
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = begin[:-1][owner] + rank * 65535
    lone = len(owner) == int((parts > 0).sum())
    for k in range(16):
        total = np.add.reduceat((h >> U64(k)) & _LANES, start)
        for lane in range(4):
            bits = ((total >> U64(16 * lane)) & U64(0xFFFF)).astype(np.int64)
            if lone:
                out[owner, 16 * lane + k] = bits
            else:
                np.add.at(out[:, 16 * lane + k], owner, bits)
    return out


def byte_class(members: str) -> np.ndarray:
    """Table of 256 flags for the ASCII characters in ``members``."""
    table = np.zeros(256, bool)
    table[list(members.encode("ascii"))] = True
    return table


def longest_runs(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """Length of each text's longest run of bytes of a class."""
    data, at = texts(column)
    out = np.zeros(len(at) - 1, np.int64)
    for i, j in blocks(at):
        block = data[at[i] : at[j]]
        if not len(block):
            continue
        edge = at[i : j + 1] - at[i]
        inside = table[block]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = edge[1:-1]
        cuts = cuts[cuts < len(block)]
        first[cuts] = inside[cuts]
        stop = ~inside
        stop[cuts] = True
        start = np.flatnonzero(first)
        if not len(start):
            continue
        stops = np.append(np.flatnonzero(stop), len(block))
        size = stops[np.searchsorted(stops, start, "right")] - start
        np.maximum.at(out, i + np.searchsorted(edge, start, "right") - 1, size)
    return out


def counts(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """How many bytes of each text are in a class."""
    data, at = texts(column)
    out = np.zeros(len(at) - 1, np.int64)
    for i, j in blocks(at):
        total = np.concatenate([[0], np.cumsum(table[data[at[i] : at[j]]])])
        out[i:j] = total[at[i + 1 : j + 1] - at[i]] - total[at[i:j] - at[i]]
    return out
