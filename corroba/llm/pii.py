"""Personal data by offset-preserving deobfuscation.

A text passes a chain of transducers (``TRANSDUCERS``). Each finds disguises and rewrites them: homoglyphs
and invisible characters, spelled digits, at/dot disguises. Along with the rewritten text goes, for
every character, the range of source characters it stands for. Identifiers are detected in the plain
text (base spans) and in the rewritten one; spans of the latter are mapped back to source characters
and added where they cover a disguise and no base span of the kind holds them already.

Defined results: null and empty texts have no spans; null or repeated ids are handled row by row; an
empty table gives no rows; other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as T
from ._frames import map_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- detection ---------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails at its start fails at all its later starts, so the look-behind only saves time
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping. The local part is the run before an @, back to the last match or @."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        low = found.end() if found else at + 1
        at = text.find("@", low)
    return out


def detect(text: str) -> list[Span]:
    """Spans by kind as listed, then start; ends are exclusive."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- transducers -------------------------------------------------------------------------------

# Letters of other scripts that look like ASCII ones.
_LOOKALIKE = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοικρν", "aeopcyxijshdqwABEKMHOPCTXIJSABEZHIKMNOPTYXoikpv", strict=True))
# Characters without width.
_INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in English, French, Spanish and German.
_SPELLED = {w: str(d) for d, some in enumerate(("zero zéro cero null", "one un uno eins", "two deux dos zwei", "three trois tres drei", "four quatre cuatro vier", "five cinq cinco fünf", "six seis sechs", "seven sept siete sieben", "eight huit ocho acht", "nine neuf nueve neun")) for w in some.split()}
_NUMBER = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_AT, _DOT = "(?:at|arobase|arroba)", "(?:dot|point|punto|punkt)"
_LABEL = r"[A-Za-z0-9-]+"


def _folds() -> dict[str, str]:
    """Single characters that stand for one ASCII character: full-width, mathematical, enclosed, look-alikes."""
    ranges = ((0x2070, 0x209C), (0x2460, 0x24EA), (0xFE50, 0xFE6B), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF))
    found = {chr(c): n for a, b in ranges for c in range(a, b + 1) if len(n := unicodedata.normalize("NFKC", chr(c))) == 1 and " " < n <= "~"}
    return found | _LOOKALIKE | {"。": ".", "․": ".", "‐": "-", "‑": "-", "–": "-"}


_FOLD = _folds() | dict.fromkeys(_INVISIBLE, "")
_GLYPH = re.compile("[" + re.escape("".join(_FOLD)) + "]")
_RUN = re.compile(rf"(?<!\w)(?:(?P<plus>plus)[ -]+)?(?:{_NUMBER}|[0-9]+)(?:[ -]+(?:{_NUMBER}|{_DOT}|[0-9]+))*(?!\w)", re.I)
_RUN_HINT = re.compile(rf"(?<!\w){_NUMBER}[ -]+(?:{_NUMBER}|{_DOT}|[0-9])", re.I)
_PART = re.compile(rf"{_NUMBER}|{_DOT}|[0-9]+|plus|[ -]+", re.I)
_MARKED = re.compile(rf"[\[({{<]\s*(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))\s*[\])}}>]", re.I)
_BLANKS = re.compile(r"\s*")
_BARE_DOT = rf"\s+{_DOT}\s+"
_BARE = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<local>(?:{_BARE_DOT}[A-Za-z0-9_%+-]+)*)(?P<at>\s*@\s*|\s+{_AT}\s+){_LABEL}(?:(?:\.|{_BARE_DOT}){_LABEL})*(?:{_BARE_DOT}){_LABEL}(?:(?:\.|{_BARE_DOT}){_LABEL})*", re.I)
_BARE_HINT = re.compile(rf"\s{_DOT}\s", re.I)
_BARE_PARTS = re.compile(rf"(?P<dot>{_BARE_DOT})", re.I)

Edit = tuple[int, int, str]


def _glyph_edits(text: str) -> list[Edit]:
    return [] if text.isascii() else [(m.start(), m.end(), _FOLD[m.group()]) for m in _GLYPH.finditer(text)]


def _marked_edits(text: str) -> list[Edit]:
    """Bracketed forms: name [at] host (dot) tld, with the spaces around them."""
    out: list[Edit] = []
    for m in _MARKED.finditer(text):
        low = out[-1][1] if out else 0
        a, b = m.start(), _BLANKS.match(text, m.end()).end()
        while a > low and text[a - 1].isspace():
            a -= 1
        out.append((a, b, "@" if m.group("at") else "."))
    return out


def _spelled_edits(text: str) -> list[Edit]:
    """Runs of four digits or more of which some are spelled; separators inside a run go."""
    out: list[Edit] = []
    if not _RUN_HINT.search(text):
        return out
    for m in _RUN.finditer(text):
        parts = [(p.start(), p.end(), p.group().lower()) for p in _PART.finditer(text, m.start(), m.end())]
        digits = sum(len(w) if w.isdigit() else w in _SPELLED for _, _, w in parts)
        if digits < 4 or not any(w in _SPELLED for _, _, w in parts):
            continue
        for start, end, word in parts:
            new = word if word.isdigit() else _SPELLED.get(word, "" if word.strip(" -") == "" else "+" if word == "plus" else ".")
            if new != text[start:end]:
                out.append((start, end, new))
    return out


def _bare_edits(text: str) -> list[Edit]:
    """Unmarked forms, only where a whole address is spelled: name at host dot tld."""
    out: list[Edit] = []
    if not _BARE_HINT.search(text):
        return out
    for m in _BARE.finditer(text):
        out += [(*p.span("dot"), ".") for p in _BARE_PARTS.finditer(text, *m.span("local"))]
        out.append((*m.span("at"), "@"))
        out += [(*p.span("dot"), ".") for p in _BARE_PARTS.finditer(text, m.end("at"), m.end())]
    return out


TRANSDUCERS = (_glyph_edits, _marked_edits, _spelled_edits, _bare_edits)


class Rewritten:
    """A text under rewriting: for each of its characters the source range and whether it was edited."""

    def __init__(self, text: str):
        self.text = text
        self.start: np.ndarray | None = None

    def apply(self, edits: list[Edit]) -> None:
        if not edits:
            return
        if self.start is None:
            self.start = np.arange(len(self.text))
            self.end = self.start + 1
            self.edited = np.zeros(len(self.text), bool)
        texts, starts, ends, flags, done = [], [], [], [], 0
        for a, b, new in edits:
            texts += [self.text[done:a], new]
            starts += [self.start[done:a], np.full(len(new), self.start[a])]
            ends += [self.end[done:a], np.full(len(new), self.end[b - 1])]
            flags += [self.edited[done:a], np.ones(len(new), bool)]
            done = b
        self.text = "".join([*texts, self.text[done:]])
        self.start, self.end, self.edited = np.concatenate([*starts, self.start[done:]]), np.concatenate([*ends, self.end[done:]]), np.concatenate([*flags, self.edited[done:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


class Cover:
    """Whether a span of some kind lies inside one of ``base``, whose spans of a kind do not overlap."""

    def __init__(self, base: list[Span]):
        self.start: dict[str, list[int]] = {}
        self.end: dict[str, list[int]] = {}
        for kind, a, b in sorted(base, key=lambda s: s[1]):
            self.start.setdefault(kind, []).append(a)
            self.end.setdefault(kind, []).append(b)

    def holds(self, kind: str, a: int, b: int) -> bool:
        at = bisect.bisect_right(self.start.get(kind, ()), a) - 1
        return at >= 0 and b <= self.end[kind][at]


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows, in source characters."""
    r = Rewritten(text)
    for rule in TRANSDUCERS:
        r.apply(rule(r.text))
    if r.start is None:
        return []
    out: list[Span] = []
    cover = Cover(base)
    touched = np.concatenate([[0], np.cumsum(r.edited)])
    gone = np.concatenate([[False], r.start[1:] != r.end[:-1]]) if len(r.start) else np.zeros(0, bool)  # deleted characters before
    breaks = np.concatenate([[0], np.cumsum(gone)])
    for kind, a, b in detect(r.text):
        if touched[b] > touched[a] or breaks[b] > breaks[min(a + 1, b)]:
            start, end = r.source(a, b)
            if not cover.holds(kind, start, end):
                out.append((kind, start, end))
    return out


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by kind as listed, then start."""
    base = detect(text)
    more = disguised(text, base)
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if more else base


def told(some: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in some)


_EMPTY = hashlib.sha256(b"").hexdigest()
_DIGIT, _SIGN, _BRACKET = T.byte_class("0123456789"), T.byte_class("@+"), T.byte_class("[({<")
#: Lead bytes of characters beyond U+00FF, and that of the soft hyphen's range.
_FAR = np.isin(np.arange(256), [0xC2, *range(0xC4, 0x100)])
_TERM = T.byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") | (np.arange(256) >= 0x80)


def _hashes_of(terms: list[str]) -> np.ndarray:
    return np.sort(next(T.words(pa.array([" ".join(terms)]))).hashes())


_NUMBER_TERMS, _DOT_TERMS = _hashes_of(sorted(_SPELLED)), _hashes_of(["dot", "point", "punto", "punkt"])
_MAYBE = np.zeros(1 << 16, bool)
_MAYBE[np.concatenate([_NUMBER_TERMS, _DOT_TERMS]) >> np.uint64(48)] = True


def spelled_hints(column: pa.Array) -> np.ndarray:
    """Texts with a word for a dot, or a spelled digit next to another or to digits."""
    out = np.zeros(len(column), bool)
    for w in T.words(column, table=_TERM):
        h = w.hashes()
        at = np.flatnonzero(_MAYBE[h >> np.uint64(48)])
        dots, spelled = at[np.isin(h[at], _DOT_TERMS)], at[np.isin(h[at], _NUMBER_TERMS)]
        numeric = _DIGIT[w.data[w.start]] if len(h) else np.zeros(0, bool)
        numeric[spelled] = True
        before, after = numeric[np.maximum(spelled - 1, 0)] & (spelled > 0), numeric[np.minimum(spelled + 1, len(h) - 1)] & (spelled + 1 < len(h))
        hits = np.concatenate([dots, spelled[before | after]])
        out[w.first + np.searchsorted(w.begin, hits, "right") - 1] = True
    return out


def batch_spans(column: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """``spans`` of each text. Counts over the bytes tell which texts can hold identifiers or disguises at all."""
    digits, signs = T.counts(column, _DIGIT), T.counts(column, _SIGN)
    masked = (T.counts(column, _FAR) > 0) | (T.counts(column, _BRACKET) > 0) | spelled_hints(column)
    out = []
    for value, n, s, hidden in zip(column, digits, signs, masked, strict=True):
        if hidden:
            out.append(spans(value.as_py()))
        elif n >= 4 or s:
            base = detect(value.as_py())
            out.append((base, base))
        else:
            out.append(([], []))
    return out


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base counts by kind, SHA-256 of the base spans, all spans."""

    def make():
        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = batch_spans(part.column(1))
                numbers = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in found], pa.int64()) for kind in KINDS]
                digests = pa.array([hashlib.sha256(told(base).encode()).hexdigest() if base else _EMPTY for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, digests, pa.array([told(every) for _, every in found], pa.string())], [id, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

        return step

    kind = dict(docs.dtypes)[id]
    return map_arrow(docs, [id, text], f"`{id}` {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string", make)


def redacted(text: str, every: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its (first) kind in brackets."""
    out, done, last = [], 0, 0
    for kind, a, b in sorted(every, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[done:a], f"[{kind.upper()}]"]
        last = max(last, b)
        done = last
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``length``, if there is one, is counted anew."""
    names = docs.columns
    schema = ", ".join(f"`{n}` {k}" for n, k in docs.dtypes)
    at_text = names.index(text)
    at_length = names.index(length) if length in names else None

    def make():
        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = batch_spans(part.column(at_text))
                if not any(every for _, every in found):
                    yield part
                    continue
                columns = part.columns
                new = [redacted(v.as_py(), every) if every else v.as_py() for v, (_, every) in zip(part.column(at_text), found, strict=True)]
                columns[at_text] = pa.array(new, part.schema.field(at_text).type)
                if at_length is not None:
                    old = part.column(at_length).to_pylist()
                    columns[at_length] = pa.array([len(t) if every else n for t, n, (_, every) in zip(new, old, found, strict=True)], part.schema.field(at_length).type)
                yield pa.RecordBatch.from_arrays(columns, names)

        return step

    return map_arrow(docs, [f"`{n}`" for n in names], schema, make)
