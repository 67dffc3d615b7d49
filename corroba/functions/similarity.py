"""Token-sort similarity: an exact ratio over candidate pairs, and a bound that filters them first."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def token_sort(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), " ")), " ")


def longest_common_subsequence(a: str, b: str) -> int:
    """Length, by bit-parallel rows: a zero bit of ``row`` is a step of the sequence."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        m = row & masks.get(c, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if not n else 200.0 * longest_common_subsequence(a, b) / n


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


def sorted_ratio(a: str, b: str) -> Column:
    """Ratio of texts that are token-sorted already; Arrow batches, candidate pairs only."""
    return pandas_udf(_ratios, "double")(a, b)


def may_reach(a: Column, b: Column, cutoff: float) -> Column:
    """Necessary for a ratio of ``cutoff``: at most (1 - cutoff) of both lengths may be edited.

    The Levenshtein distance never exceeds the number of insertions and deletions.
    """
    room = F.floor((F.length(a) + F.length(b)) * (1 - cutoff / 100.0) + 1e-9).cast("int")
    return (F.abs(F.length(a) - F.length(b)) <= room) & (F.levenshtein(a, b) <= room)
