"""Evidence classes, weights, and the corroboration score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from . import docids


def evidence_class(stored: Column, system: Column, classes: dict[str, str] | None = None) -> Column:
    known = F.create_map(*(F.lit(x) for pair in (classes or config.SYSTEM_CLASSES).items() for x in pair))
    return F.coalesce(F.nullif(stored, F.lit("")), F.try_element_at(known, F.lower(F.trim(F.coalesce(system, F.lit(""))))), F.lit("other"))


def evidence_weight(kind: Column, weights: dict[str, float] | None = None) -> Column:
    known = weights or config.EVIDENCE_WEIGHTS
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in known.items() for x in pair)), kind), F.lit(known["other"]))


def corroboration_score(sources: Column, points: Column, documents: Column) -> Column:
    """Saturating in evidence points, documents, and sources beyond the first; between 0 and 1."""
    gain = lambda rate, x: F.lit(1.0) - F.exp(F.lit(-rate) * x)
    more = F.when(sources > 1, gain(0.8, sources - 1)).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.05) + 0.65 * gain(0.9, points) + 0.20 * gain(0.25, documents) + 0.10 * more))


# fixed values: fields of an evidence object that hold document references
LIST_FIELDS = ("efta_sample", "doc_key_sample", "doc_keys", "documents")
SCALAR_FIELDS = ("document_id", "document_number", "doc_id", "raw_document_id", "raw_id", "metadata.efta")


def evidence_doc_keys(evidence: Column) -> Column:
    """Document keys of an evidence JSON object, distinct and ordered: of the fields for references whatever they look
    like, and of identifiers anywhere in the text."""
    key = lambda x: docids.doc_key(docids.extract_efta(x), docids.extract_doj_ogr(x), x)
    none = F.array().cast("array<string>")
    listed = [F.coalesce(F.from_json(F.get_json_object(evidence, f"$.{f}"), "array<string>"), none) for f in LIST_FIELDS]
    told = F.concat(*listed, F.array(*(F.get_json_object(evidence, f"$.{f}") for f in SCALAR_FIELDS)))
    told = F.transform(F.filter(told, lambda x: F.coalesce(x, F.lit("")) != ""), key)
    efta = F.transform(F.regexp_extract_all(evidence, F.lit(r"(?i)\b(EFTA\d{6,})\b"), 1), F.upper)
    ogr = F.transform(F.regexp_extract_all(evidence, F.lit(r"(?i)\bDOJ[\s\-_]?OGR[\s\-_]?(\d{1,12})\b"), 1), lambda d: F.concat(F.lit("DOJ-OGR-"), F.when(F.length(d) < 8, F.lpad(d, 8, "0")).otherwise(d)))
    raw = F.regexp_extract_all(evidence, F.lit(r"\b(RAW-[0-9a-f]{12})\b"), 1)
    return F.array_sort(F.array_distinct(F.concat(told, *(F.coalesce(x, none) for x in (efta, ogr, raw)))))
