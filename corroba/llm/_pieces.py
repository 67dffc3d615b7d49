"""Vectorised byte-level encoding: pieces are cut by character class, and each distinct piece is encoded once.

The cut follows the pattern of byte-level vocabularies (``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``). Pieces are known by a 64-bit hash of their characters; their ids lie
in one pool, found through an open-addressing table.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from . import _text as T

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The characters with the White_Space property.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
HELD = 1 << 20  # distinct pieces after which the table is begun anew
_BASE = 0xD6E8FEB86659FD93
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point; made once in a process."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[_WHITE] = SPACE
        _classes.append(table)
    return _classes[0]


def cut(code: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Start of each piece in ``code`` (code points of texts joined; ``edge`` has the texts' offsets)."""
    n = len(code)
    kind = classes()[code]
    begins = np.zeros(n + 1, bool)
    begins[edge] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= begins[:n]
    white = kind == SPACE
    blank = np.zeros(n, bool)  # the character before is a plain space of the same text
    blank[1:] = (code[:-1] == 0x20) & ~begins[1:n]
    follows = np.zeros(n, bool)  # a character of the same text follows that is no white space
    follows[:-1] = ~white[1:] & ~begins[1:n]
    start = np.where(white, change | follows, change & ~blank)
    quote = np.flatnonzero((code == 0x27) & start)
    if len(quote):
        at = np.concatenate([code, np.zeros(3, code.dtype)])
        room = edge[np.searchsorted(edge, quote, "right")] - quote
        one, two = at[quote + 1], at[quote + 2]
        short = (room >= 2) & np.isin(one, [0x73, 0x74, 0x6D, 0x64])
        long = (room >= 3) & (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C))
        size = np.where(short, 2, np.where(long, 3, 0))
        on = size > 0
        start[quote[on] + 1] = False
        after = quote[on] + size[on]
        start[after[(after < n)]] = True
    return np.flatnonzero(start)


class Table:
    """Open-addressing map from 64-bit hashes to (offset, count) in a pool of ids; it grows before it is half full."""

    def __init__(self, bits: int = 16):
        self._empty(bits)
        self.offset = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.used = 0

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros(1 << bits, np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where it is new."""
        mask = np.uint64((1 << self.bits) - 1)
        at = h & mask
        found = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        while len(open_):
            key = self.key[at[open_]]
            hit = key == h[open_]
            found[open_[hit]] = self.value[at[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
            at[open_] = (at[open_] + np.uint64(1)) & mask
        return found

    def add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        """New, distinct, non-zero hashes with their ids."""
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.count)
        self.offset = np.concatenate([self.offset, len(self.pool) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.pool = np.concatenate([self.pool, np.fromiter((x for some in ids for x in some), np.uint32, int(count.sum()))])
        if 2 * (self.used + len(h)) > len(self.key):
            old = self.key != 0
            key, value = self.key[old], self.value[old]
            self._empty(int(np.ceil(np.log2(4 * (self.used + len(h))))))
            self._put(key, value)
        self._put(h, np.arange(first, first + len(h)))
        self.used += len(h)

    def _put(self, h: np.ndarray, value: np.ndarray) -> None:
        mask = np.uint64((1 << self.bits) - 1)
        at = h & mask
        left = np.arange(len(h))
        while len(left):
            free = left[self.key[at[left]] == 0]
            _, pick = np.unique(at[free], return_index=True)
            won = free[pick]
            self.key[at[won]], self.value[at[won]] = h[won], value[won]
            left = left[self.key[at[left]] != h[left]]
            at[left] = (at[left] + np.uint64(1)) & mask


class Encoder:
    """Ids of texts under a byte-level ``.json`` vocabulary."""

    def __init__(self, path: str, held: int = HELD):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        cutter = told["pre_tokenizer"] or {}
        if told["normalizer"] is not None or (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex")) != ("ByteLevel", False, True):
            raise ValueError(f"{path}: only byte-level vocabularies with the usual pattern, and no normalizer, are handled")
        self.special = [x["content"] for x in told["added_tokens"]]
        self.held = held
        self.table = Table()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), and the texts' offsets in them."""
        odd = {i: self.whole.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if "<" in t and any(x in t for x in self.special)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)] if odd else texts
        size = np.fromiter(map(len, plain), np.int64, len(plain))
        edge = np.concatenate([[0], np.cumsum(size)])
        joined = "".join(plain)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        start = cut(code, edge)
        stop = np.append(start[1:], len(code))
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code + np.uint32(1)).astype(np.uint64) * T._power(_BASE, len(code)), out=total[1:])
        h = T.mix((total[stop] - total[start]) * T._power(pow(_BASE, -1, 1 << 64), len(code) + 1)[start]) | np.uint64(1)
        if self.table.used > self.held:
            self.table = Table()
        at = self.table.find(h)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh, pick = np.unique(h[new], return_index=True)
            pieces = [joined[a:b] for a, b in zip(start[new[pick]].tolist(), stop[new[pick]].tolist(), strict=True)]
            self.table.add(fresh, [x.ids for x in self.whole.encode_batch(pieces, add_special_tokens=False)])
            at[new] = self.table.find(h[new])
        count = self.table.count[at]
        ends = np.cumsum(count)
        ids = self.table.pool[np.repeat(self.table.offset[at] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(start, edge)]
        if odd:
            parts = [np.array(odd[i], np.uint32) if i in odd else ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds
