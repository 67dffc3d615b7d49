"""Secrets: named patterns, and sliding-window Shannon entropy over candidate strings.

Candidates are maximal runs of token characters of ``WINDOW`` or more. A window slides over each; counts
of its characters, and with them the entropy, are updated by the one that leaves and the one that enters. A
window is kept if its character class (hex, lower with digits, mixed case with digits) reaches the
class's threshold; kept windows that overlap are joined into one span. Spans that the allow-list
explains (UUIDs, plain numbers, stated digests, alphabets, long words) are suppressed, and those
inside a base span are not repeated.

Defined results: null and empty texts have no spans; null or repeated ids are handled row by row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as T
from ._frames import map_arrow
from .pii import Cover

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "entropy")
Span = tuple[str, int, int]
WINDOW = 20
#: Bits per character that a window of each class needs.
THRESHOLDS = {"hex": 3.1, "lower": 3.4, "mixed": 3.7}

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
ALLOW = (
    re.compile(r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),  # UUID
    re.compile(r"^[0-9+/_=-]+$"),  # numbers, dates, rules
    re.compile(r"^(?:[A-Za-z]+[-_/+=])+[A-Za-z]*[0-9]{0,4}$"),  # joined words
    re.compile(r"(?i)abcdefghij|0123456789|qwertyuiop"),  # alphabets and keyboard rows
)
#: Words that announce a public digest just before a candidate.
ALLOW_BEFORE = re.compile(r"(?i)(?:sha-?(?:1|256|512)|md5|commit|revision|etag|checksum)[\x20:=\"']*$")
_C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def windows(s: str) -> list[tuple[int, int]]:
    """Joined windows of ``s`` whose entropy reaches the threshold of their class."""
    out: list[tuple[int, int]] = []
    n: dict[str, int] = {}
    total = 0.0  # sum of c log2 c
    upper = lower = digit = beyond = 0  # beyond: characters that are no hex digits
    for i, c in enumerate(s):
        for step, x in ((1, c), (-1, s[i - WINDOW] if i >= WINDOW else "")):
            if x:
                before = n.get(x, 0)
                n[x] = before + step
                total += _C_LOG_C[before + step] - _C_LOG_C[before]
                upper += step * ("A" <= x <= "Z")
                lower += step * ("a" <= x <= "z")
                digit += step * ("0" <= x <= "9")
                beyond += step * (not ("0" <= x <= "9" or "a" <= x <= "f" or "A" <= x <= "F"))
        if i < WINDOW - 1 or digit < 2 or upper + lower == 0:
            continue
        kind = "hex" if not beyond and not (upper and lower) else "mixed" if upper and lower else "lower" if digit >= 3 else ""
        if kind and math.log2(WINDOW) - total / WINDOW >= THRESHOLDS[kind]:
            a, b = i - WINDOW + 1, i + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    return out


def entropy_spans(text: str, base: list[Span]) -> list[Span]:
    out: list[Span] = []
    cover = Cover(base)
    for m in _CANDIDATE.finditer(text):
        if any(rule.search(m.group()) for rule in ALLOW) or ALLOW_BEFORE.search(text[max(0, m.start() - 16) : m.start()]):
            continue
        for a, b in windows(m.group()):
            a, b = a + m.start(), b + m.start()
            if not any(cover.holds(kind, a, b) for kind in BASE):
                out.append(("entropy", a, b))
    return out


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start, then kind as listed."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=order)
    more = entropy_spans(text, base)
    return base, sorted(base + more, key=order) if more else base


_RUN = T.byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_SET = T.byte_class(":=")
_EMPTY = hashlib.sha256(b"").hexdigest()


def batch_spans(column: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """``spans`` of each text; only those with a long run of token characters or a sign of assignment are searched."""
    runs, signs = T.longest_runs(column, _RUN), T.counts(column, _SET)
    return [spans(value.as_py()) if run >= WINDOW or sign else ([], []) for value, run, sign in zip(column, runs, signs, strict=True)]


def told(some: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in some)


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base counts by kind, SHA-256 of the base spans, all spans."""

    def make():
        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = batch_spans(part.column(1))
                numbers = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in found], pa.int64()) for kind in BASE]
                digests = pa.array([hashlib.sha256(told(base).encode()).hexdigest() if base else _EMPTY for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, digests, pa.array([told(every) for _, every in found], pa.string())], [id, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

        return step

    kind = dict(docs.dtypes)[id]
    return map_arrow(docs, [id, text], f"`{id}` {kind}, " + ", ".join(f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string", make)
