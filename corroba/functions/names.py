"""Names as Column expressions. Each refers to its input few times, so chains stay small in the plan."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

_U = "(?U)"  # \s, \w, \d, \b over Unicode


def _lit(words: Iterable[str]) -> str:
    return "|".join(re.sub(r"([^\w ])", r"\\\1", w) for w in words)


def let(value: Column, body) -> Column:
    """``body(value)``, where ``value`` is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _U + r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, _U + r"\s+", " "))


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{L}", ""))


def capitals(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{Lu}", ""))


def is_redaction_marker(c: Column) -> Column:
    """Null, empty, a redaction code, a bracketed marker, a placeholder word, or a single character."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return s.startswith("(b)") | s.rlike(r"\[redacted\]|\[sealed\]") | s.isin(*config.REDACTED_WORDS) | (F.length(s) <= 1)


def looks_like_non_entity(c: Column) -> Column:
    def test(s: Column) -> Column:
        n = letters(s)
        return (
            (s == "")
            | s.rlike(r"[\n\t]|(?i:https?://)")
            | (s.contains("@") & s.contains("."))
            | (F.length(s) > 90)
            | (F.size(F.split(s, _U + r"\s+")) > 7)
            | (n == 0)
            | ((F.length(s) >= 25) & (n / F.greatest(F.length(s), F.lit(1)) < 0.35))
        )

    return let(strip(F.coalesce(c, F.lit(""))), test)


def normalize_name(c: Column, suffixes: Iterable[str] = config.NAME_SUFFIXES) -> Column:
    """Suffixes off in list order, one pass; ``LAST, FIRST`` flipped at the first comma; parentheses off."""
    # the first suffix of the list is the last one standing; each may be there once
    chain = "".join(rf"(?:\s*{_lit([x])})?" for x in reversed(tuple(suffixes)))
    s = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), _U + chain + r"\z", "")
    s = F.regexp_replace(s, r"(?U)(?s)^([^,]*[^,\s])\s*,\s*(\S.*?)\s*\z", "$2 $1")
    return squeeze(F.regexp_replace(s, _U + r"\s*\([^)]*\)\s*", " "))


def short_name(c: Column) -> Column:
    """First and last word of the normalised name."""
    return F.regexp_replace(normalize_name(c), r"^(\S+) .* (\S+)$", "$1 $2")


def strip_titles(c: Column, titles: Iterable[str] = config.TITLES) -> Column:
    return F.regexp_replace(strip(c), rf"(?U)(?i)^(?:(?:{_lit(titles)})\s*)+", "")


def has_title(c: Column, titles: Iterable[str] = config.TITLES) -> Column:
    return F.lower(c).rlike(rf"^(?:{_lit(titles)})")


def to_title_case(c: Column) -> Column:
    """Mostly capital names in title case; others as they are."""
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))

    def word(w: Column) -> Column:
        hyphened = F.array_join(F.transform(F.split(w, "-"), capital), "-")
        return F.when(w.contains("-"), hyphened).when((F.upper(w) == w) & (F.length(w) <= 3) & w.contains("."), w).otherwise(capital(w))

    def whole(s: Column) -> Column:
        n = letters(s)
        return F.when((n == 0) | (capitals(s) / F.greatest(n, F.lit(1)) < 0.7), s).otherwise(F.array_join(F.transform(F.split(squeeze(s), " "), word), " "))

    return let(c, whole)


def clean_name(c: Column) -> Column:
    """For matching only: titles off, case folded, punctuation, stutter and inner single letters off."""
    s = F.lower(normalize_name(to_title_case(strip_titles(F.coalesce(c, F.lit(""))))))
    s = squeeze(F.replace(F.regexp_replace(s, "[.,]", ""), F.lit("-"), F.lit(" ")))
    s = F.regexp_replace(s, r"^(\S+) \1 (?=\S)", "$1 ")
    return F.regexp_replace(s, r"(?<=\S )\S (?=\S)", "")


def is_noise_name(c: Column) -> Column:
    """No entity, or too generic. Substrings are matched anywhere, inside words too."""
    s = F.lower(normalize_name(c))
    return looks_like_non_entity(c) | let(s, lambda x: (x == "") | x.rlike(_lit(config.NOISE_SUBSTRINGS)) | x.rlike("(?U)(?i)" + "|".join(f"(?:{p})" for p in config.NOISE_PATTERNS)))


def is_numbered_reference(c: Column) -> Column:
    return c.rlike("(?U)(?i)" + config.NUMBERED_PATTERN)


def is_expanded_noise(c: Column, protected: Iterable[str] = config.PROTECTED_WORDS, extra_patterns: Iterable[str] = ()) -> Column:
    """Base noise first; then protected words pass; then generic words, first names, question marks, patterns."""

    def test(s: Column) -> Column:
        low = F.lower(s)
        guarded = low.isin(*protected) if protected else F.lit(False)
        return (
            F.when(is_noise_name(s), True)
            .when(guarded, False)
            .when(low.isin(*config.GENERIC_WORDS) | (low.isin(*config.FIRST_NAMES) & ~s.contains(" ")), True)
            .when(s.endswith(" ?") | (s.endswith("?") & (F.length(s) <= 15)), True)
            .otherwise(s.rlike(_U + "|".join(f"(?:{p})" for p in (*config.EXPANDED_PATTERNS, *extra_patterns))))
        )

    return let(strip(F.coalesce(c, F.lit(""))), test)


def noise_reason(c: Column) -> Column:
    """Label of the first rule that explains a noise name."""

    def label(s: Column) -> Column:
        low = F.lower(s)
        return (
            F.when(low.isin(*config.GENERIC_WORDS), F.concat(F.lit("generic_word:"), low))
            .when(low.isin(*config.FIRST_NAMES) & ~s.contains(" "), F.concat(F.lit("standalone_first_name:"), low))
            .when(s.endswith("?"), F.lit("question_mark_placeholder"))
            .when(is_noise_name(s), F.lit("base_noise_filter"))
            .when(s.rlike(_U + "|".join(f"(?:{p})" for p in config.EXPANDED_PATTERNS)), F.concat(F.lit("pattern_match:"), s))
            .otherwise(F.lit("expanded_noise"))
        )

    return let(strip(F.coalesce(c, F.lit(""))), label)


def is_graph_noise(c: Column) -> Column:
    return F.lower(c).rlike(_lit(config.GRAPH_NOISE))


def is_ranking_noise(c: Column) -> Column:
    def test(s: Column) -> Column:
        return (s == "") | s.rlike(_lit(config.RANKING_NOISE)) | s.rlike("(?U)(?i)" + "|".join(f"(?:{p})" for p in config.RANKING_PATTERNS))

    return let(F.lower(strip(F.coalesce(c, F.lit("")))), test)


def display_name(c: Column) -> Column:
    """Cleaned for display: titles off, title case, stutter off, white space squeezed."""
    return F.regexp_replace(squeeze(to_title_case(strip_titles(c))), r"^(\S+) \1 (?=\S)", "$1 ")


def action_type(c: Column) -> Column:
    """First listed phrase that the action contains decides."""
    low, out = F.lower(F.coalesce(c, F.lit(""))), None
    for phrase, kind in config.ACTION_TYPES:
        out = F.when(low.contains(phrase), kind) if out is None else out.when(low.contains(phrase), kind)
    return out.otherwise(config.DEFAULT_ACTION_TYPE)
