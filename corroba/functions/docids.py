"""Document identifiers as Column expressions, and the crosswalk between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import strip


def extract_efta(c: Column) -> Column:
    """EFTA number, upper case; null if there is none."""
    return F.nullif(F.upper(F.regexp_extract(c, r"(?i)\b(EFTA\d{6,})\b", 1)), F.lit(""))


def extract_doj_ogr(c: Column) -> Column:
    """DOJ-OGR number padded to eight digits; longer ones stay whole."""
    digits = F.nullif(F.regexp_extract(c, r"(?i)\bDOJ[\s\-_]?OGR[\s\-_]?(\d{1,12})\b", 1), F.lit(""))
    return F.concat(F.lit("DOJ-OGR-"), F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits))


def raw_key(c: Column) -> Column:
    """RAW- and twelve hex digits of the trimmed text's SHA-1; blank texts share a key of zeros."""
    s = strip(F.coalesce(c, F.lit("")))
    return F.concat(F.lit("RAW-"), F.when(s == "", F.lit("0" * 12)).otherwise(F.substring(F.sha1(s), 1, 12)))


def doc_key(efta: Column, ogr: Column, raw: Column) -> Column:
    """EFTA before DOJ-OGR before the raw hash; a raw key is canonical already."""
    return F.coalesce(F.nullif(efta, F.lit("")), F.nullif(ogr, F.lit("")), F.when(raw.rlike("^RAW-[0-9a-f]{12}$"), raw), raw_key(raw))


def document_class(key: Column) -> Column:
    """Order of document keys: EFTA, DOJ-OGR, raw, others."""
    up = F.upper(key)
    return F.when(up.startswith("EFTA"), 0).when(up.startswith("DOJ-OGR"), 1).when(up.startswith("RAW-"), 2).otherwise(3)


def crosswalk(refs: DataFrame) -> DataFrame:
    """DOJ-OGR -> EFTA from rows (efta, ogr, seq) that name both; the last row wins."""
    both = refs.where("efta is not null and ogr is not null")
    return both.groupBy("ogr").agg(F.max_by("efta", "seq").alias("known_efta"))


def canonicalize(refs: DataFrame, fields: list[str], links: DataFrame | None = None) -> DataFrame:
    """Adds efta, ogr and doc_key. The fields' first identifiers count; their trimmed join is the raw id.

    ``links`` maps DOJ-OGR numbers to EFTA numbers; all of it is known to every row.
    """
    trimmed = [F.nullif(strip(F.coalesce(F.col(f), F.lit(""))), F.lit("")) for f in fields]
    out = refs.withColumn("efta", F.coalesce(*(extract_efta(F.col(f)) for f in fields))).withColumn("ogr", F.coalesce(*(extract_doj_ogr(F.col(f)) for f in fields)))
    out = out.withColumn("raw_id", F.concat_ws(" | ", *trimmed))
    if links is not None:
        out = out.join(links, "ogr", "left").withColumn("efta", F.coalesce("efta", "known_efta")).drop("known_efta")
    return out.withColumn("doc_key", doc_key(F.col("efta"), F.col("ogr"), F.col("raw_id")))


def upsert(rows: DataFrame) -> DataFrame:
    """One row per doc_key: of each column the last value that is not null, by ``seq``."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    return rows.groupBy("doc_key").agg(*(last(c) for c in rows.columns if c not in ("doc_key", "seq")))


def merge_documents(old: Column, new: Column, cap: int = 200) -> Column:
    """Distinct document keys of both arrays, ordered by class and upper-case key, at most ``cap``."""
    every = F.array_distinct(F.concat(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))))
    keyed = F.transform(F.filter(every, lambda x: x.isNotNull() & (x != "")), lambda x: F.struct(document_class(x).alias("c"), F.upper(x).alias("u"), x.alias("x")))
    return F.slice(F.transform(F.array_sort(keyed), lambda s: s["x"]), 1, cap)
