"""Quality rules learned as a decision list. Native DataFrame operations only.

Statistics of every whole text are computed by column expressions and written. Candidate thresholds are quantiles
of the labelled rows of each kind; for each feature the ``STEPS`` that tell the kinds apart best, and some spread
over its range, are kept. Labelled rows are then counted by cells between thresholds, so the table that the driver
sees has at most as many rows as there are cells, whatever the input. On it, sequential covering goes by folds: it
grows a conjunction of thresholds on all folds but one (best FOIL gain) and prunes its last conditions on that one,
for each fold in turn; the rule that is most precise on its own fold, and on all rows, is kept, what it covers is
removed, and so on until no rule is precise. The list becomes one ordered chain of ``when`` expressions.

Repeated 3-word windows are recognised by a 64-bit hash of the three words.

Defined results: a null or empty text has no words and fails the base rule; null ids take no part in
learning; an id labelled twice counts as its lowest label; repeated rows are all returned; without labels of both
kinds the list is empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._frames import written

FEATURES = ("n_words", "mean_word", "symbols", "capitals", "repeated", "distinct", "dup_lines")
QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
#: Thresholds kept for a feature; the cells are at most (STEPS + 1) to the power of the features.
STEPS = 6
MIN_PRECISION = 0.9
FOLDS = 3
#: A rule must hold for this share of the bad rows, and for two at least.
MIN_SHARE = 0.02

Grid = dict[str, tuple[float, ...]]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that are found twice or more."""

    def marked(hashes: Column) -> Column:
        def count(s: Column) -> Column:
            twin = lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
            starts = F.filter(s, lambda e, i: F.coalesce(twin(e, i), F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))))
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))

        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(ordered, count))

    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return _let(windows, marked)


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and the statistics of each text, all long."""
    space = r"[\x20\x09-\x0D]+"
    content = F.coalesce(F.col(text), F.lit(""))
    size = lambda c: F.size(c).cast("long")

    def of_lines(lines: Column) -> Column:
        return F.struct(size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    def of_words(words: Column) -> Column:
        return F.struct(size(words).alias("n"), F.length(F.array_join(words, "")).cast("long").alias("chars"), size(F.array_distinct(words)).alias("distinct"), _repeated_words(words).cast("long").alias("repeat"))

    words = _let(F.array_remove(F.split(content, space), ""), of_words)
    lines = _let(F.filter(F.split(content, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines)
    only = lambda kept: F.length(F.regexp_replace(content, rf"[^{kept}]+", "")).cast("long")
    rows = docs.select(id, words.alias("w"), lines.alias("l"), only("#*$%&|<>").alias("n_symbols"), only(r"\p{Lu}").alias("n_capitals"))
    return rows.select(id, F.col("w.n").alias("n_words"), F.col("w.chars").alias("word_chars"), "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("w.repeat").alias("n_repeat_words"), F.col("w.distinct").alias("n_distinct_words"), F.col("l.n").alias("n_lines"), "n_capitals")


def features() -> dict[str, Column]:
    """``FEATURES`` over the columns of ``statistics``."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": ratio("word_chars", "n_words"),
        "symbols": ratio("n_symbols", "word_chars"),
        "capitals": ratio("n_capitals", "word_chars"),
        "repeated": ratio("n_repeat_words", "n_words"),
        "distinct": ratio("n_distinct_words", "n_words"),
        "dup_lines": ratio("n_dup_lines", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    below: bool  # below the threshold, or else at or above it
    step: int  # index of the threshold in the feature's grid
    threshold: float

    def holds(self, cell: dict[str, int]) -> bool:
        return (cell[self.feature] <= self.step) == self.below

    def __str__(self) -> str:
        return f"{self.feature} {'<' if self.below else '>='} {self.threshold:g}"

    def column(self, made: dict[str, Column]) -> Column:
        return made[self.feature] < self.threshold if self.below else made[self.feature] >= self.threshold


Cell = tuple[dict[str, int], tuple[float, ...], tuple[float, ...]]  # bins; bad and good rows by fold


def _covered(rule: list[Condition], cells: list[Cell], folds: list[int]) -> tuple[float, float]:
    """Bad and good rows of the folds for which the rule holds."""
    held = [c for c in cells if all(x.holds(c[0]) for x in rule)]
    return sum(c[1][k] for c in held for k in folds), sum(c[2][k] for c in held for k in folds)


def grow(cells: list[Cell], candidates: list[Condition], folds: list[int], min_rows: float) -> list[Condition]:
    """A conjunction with the best FOIL gain at each step; ties go to the first candidate."""
    rule: list[Condition] = []
    counts = [(c[0], sum(c[1][k] for k in folds), sum(c[2][k] for k in folds)) for c in cells]
    while True:
        bad, good = sum(c[1] for c in counts), sum(c[2] for c in counts)
        best, gain = None, 1e-9
        for x in candidates if good > 0 and bad > 0 else ():
            b = sum(c[1] for c in counts if x.holds(c[0]))
            if b < min_rows:
                continue
            g = sum(c[2] for c in counts if x.holds(c[0]))
            won = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good)))
            if won > gain:
                best, gain = x, won
        if best is None:
            return rule
        rule.append(best)
        counts = [c for c in counts if best.holds(c[0])]


def learn(cells: list[Cell], grid: Grid, min_precision: float = MIN_PRECISION, min_share: float = MIN_SHARE) -> list[list[Condition]]:
    """Rules for bad rows in order, by growing and pruning; ties go to the first fold."""
    candidates = [Condition(f, below, i, t) for f, steps in grid.items() for i, t in enumerate(steps) for below in (True, False)]
    every = list(range(len(cells[0][1]))) if cells else []
    min_rows = max(2.0, min_share * _covered([], cells, every)[0])
    rules: list[list[Condition]] = []
    rest = list(cells)
    while True:
        found: list[tuple[float, int, list[Condition]]] = []
        for own in every:
            rule = grow(rest, candidates, [k for k in every if k != own], min_rows)
            told = [_covered(rule[:n], rest, [own]) for n in range(1, len(rule) + 1)]
            sure = [(bad + 1) / (bad + good + 2) for bad, good in told]
            if not rule:
                continue
            n = max(range(len(rule)), key=lambda n: (sure[n], -n))
            bad, good = _covered(rule[: n + 1], rest, every)
            if told[n][0] >= 1 and min(told[n][0] / sum(told[n]), bad / (bad + good)) >= min_precision and bad >= min_rows:
                found.append((sure[n], -own, rule[: n + 1]))
        if not found:
            return rules
        best = max(found, key=lambda x: x[:2])[2]
        rules.append(best)
        rest = [c for c in rest if not all(x.holds(c[0]) for x in best)]


def labelled(stats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(bad, fold, features) of the labelled rows; every fifth id is held out."""
    fold = F.crc32(F.col(id).cast("string").cast("binary"))
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(id).agg(F.min(label).alias("label")).where(fold % 5 != 0)
    made = features()
    return stats.join(known, id).select((F.col("label") == 0).alias("bad"), F.pmod(F.xxhash64(id), F.lit(FOLDS)).alias("fold"), *(made[f].alias(f) for f in FEATURES))


def _entropy(bad: float, good: float) -> float:
    n = bad + good
    return -sum(x / n * math.log2(x / n) for x in (bad, good) if x) if n else 0.0


def thresholds(rows: DataFrame, steps: int = STEPS) -> Grid:
    """For each feature up to ``steps`` thresholds, ascending, from the quantiles of bad and of good rows."""
    found = rows.groupBy("bad").agg(*(F.percentile_approx(f, F.array(*map(F.lit, QUANTILES)), F.lit(10_000)).alias(f) for f in FEATURES)).collect()  # a row per kind
    if len(found) < 2:
        return {}
    every = {}
    for f in FEATURES:
        at = sorted({x for r in found for x in r[f]})
        every[f] = sorted({*at[1:], *((a + b) / 2 for a, b in zip(at, at[1:], strict=False))})
    counts = [F.sum((F.col("bad") & (F.col(f) < t)).cast("long")).alias(f"{f}_{i}_1") for f, some in every.items() for i, t in enumerate(some)]
    counts += [F.sum((~F.col("bad") & (F.col(f) < t)).cast("long")).alias(f"{f}_{i}_0") for f, some in every.items() for i, t in enumerate(some)]
    row = rows.agg(F.sum(F.col("bad").cast("long")).alias("bad"), F.count("*").alias("n"), *counts).first()
    grid: Grid = {}
    for f, some in every.items():

        def rest(i: int, f: str = f) -> float:
            """Entropy that is left when the rows are divided at the threshold."""
            b, g = row[f"{f}_{i}_1"], row[f"{f}_{i}_0"]
            return (b + g) * _entropy(b, g) + (row.n - b - g) * _entropy(row.bad - b, row.n - row.bad - g)

        best = sorted(range(len(some)), key=lambda i: (rest(i), i))[: steps // 2]
        others = [i for i in range(len(some)) if i not in best]
        room = min(steps - len(best), len(others))
        best += [others[(2 * k + 1) * len(others) // (2 * room)] for k in range(room)]
        if best:
            grid[f] = tuple(some[i] for i in sorted(best))
    return grid


def counted(rows: DataFrame, grid: Grid) -> list[Cell]:
    """Labelled rows by cell of the grid."""
    bins = [sum((F.when(F.col(f) >= t, 1).otherwise(0) for t in steps[1:]), F.when(F.col(f) >= steps[0], 1).otherwise(0)).alias(f"bin_{f}") for f, steps in grid.items()]
    count = lambda fold, bad: F.sum(((F.col("fold") == fold) & (F.col("bad") == bad)).cast("long")).alias(f"{'bad' if bad else 'good'}_{fold}")
    table = rows.select("bad", "fold", *bins).groupBy(*(f"bin_{f}" for f in grid)).agg(*(count(k, bad) for bad in (True, False) for k in range(FOLDS)))
    found = table.collect()  # at most one row per cell of the grid
    cells = [({f: r[f"bin_{f}"] for f in grid}, *(tuple(float(r[f"{kind}_{k}"]) for k in range(FOLDS)) for kind in ("bad", "good"))) for r in found]
    return sorted(cells, key=lambda c: tuple(c[0].values()))


def rules_of(stats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality") -> list[list[Condition]]:
    """The decision list that the labelled rows of ``stats`` teach."""
    rows = written(labelled(stats, labels, id, label), "quality-labelled")
    grid = thresholds(rows)
    return learn(counted(rows, grid), grid) if grid else []


def verdict(rules: list[list[Condition]]) -> Column:
    """False at the first rule that holds, else true."""
    made = features()
    out = None
    for rule in rules:
        test = rule[0].column(made)
        for x in rule[1:]:
            test = test & x.column(made)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of ``docs``: id, base statistics, base_failed, kept."""
    stats = written(statistics(docs, id, text), "quality-statistics")
    rules = rules_of(stats, labels, id, label)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select(id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
