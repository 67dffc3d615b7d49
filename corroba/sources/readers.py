"""Source readers. Paths are read by Spark, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import names


def file_size(spark: SparkSession, path: str) -> int:
    """Bytes under ``path``, 0 if there is nothing."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def available(spark: SparkSession, path: str, least: int = 1000) -> bool:
    """Whether a source is there and more than a pointer file."""
    return file_size(spark, path) >= least


def optional(spark: SparkSession, path: str, schema: str, least: int = 1000) -> DataFrame:
    """A Parquet source, or an empty frame of the schema where it is missing."""
    return spark.read.schema(schema).parquet(path) if available(spark, path, least) else spark.createDataFrame([], schema)


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON arrays, a file or a folder of files, as rows with ``pos``, their place. A file is parsed as a stream, row by row."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("pos", F.monotonically_increasing_id())


def _struct(schema: str) -> str:
    """``a int, b array<x>`` in the notation of a struct's fields."""
    out, depth, first = [], 0, True
    for word in schema.replace("<", " < ").replace(">", " > ").replace(",", " , ").split():
        depth += (word == "<") - (word == ">")
        if depth == 0 and word == ",":
            out.append(",")
            first = True
        elif first:
            out.append(word + ":")
            first = False
        else:
            out.append(word)
    return "".join(out)


def person_registry(spark: SparkSession, path: str) -> DataFrame:
    """Persons in file order without redacted names, with dense ids and their place."""
    rows = json_rows(spark, path, schemas.PERSON_REGISTRY).where(~names.is_redaction_marker(F.col("name")))
    from ..operators.resolve import next_ids

    return next_ids(rows, ["pos"], 0, "PER")


def graph_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities whose aliases and metadata are JSON inside text."""
    rows = json_rows(spark, path, schemas.GRAPH_ENTITIES)
    return rows.withColumn("aliases", F.from_json("aliases", "array<string>")).withColumn("entity_type", F.coalesce("entity_type", F.lit("person"))).withColumn("name", names.strip(F.col("name")))


def graph_relationships(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, schemas.GRAPH_RELATIONSHIPS)


def dedupe_map(spark: SparkSession, path: str) -> DataFrame:
    """(kind, variant, canonical) from an object of maps."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return whole.select(F.explode("m").alias("kind", "inner")).select("kind", F.explode("inner").alias("variant", "canonical"))


def document_analyses(spark: SparkSession, path: str) -> DataFrame:
    """Analyses given as a list, as an object by document id, or as an object of lists; keys fill missing ids."""
    one = f"struct<{_struct(schemas.ANALYSIS)}>"
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = whole.where(F.col("v").startswith("[")).select(F.explode(F.from_json("v", f"array<{one}>")).alias("r"), F.lit(None).cast("string").alias("k"))
    keyed = whole.where(F.col("v").startswith("{")).select(F.explode(F.from_json("v", "map<string,string>")).alias("k", "v"))
    inner = keyed.select("k", F.when(F.col("v").startswith("["), F.from_json("v", f"array<{one}>")).otherwise(F.array(F.from_json("v", one))).alias("rs")).select(F.explode("rs").alias("r"), "k")
    every = listed.unionByName(inner)
    return every.select(F.coalesce("r.document_id", "k").alias("document_id"), "r.document_number", "r.page_count", "r.analysis")


def key_people(analyses: DataFrame) -> DataFrame:
    """(document_id, document_number, pos, name, role) of the people of each analysis."""
    return analyses.select("document_id", "document_number", F.posexplode("analysis.key_people").alias("pos", "p")).select("document_id", "document_number", "pos", "p.name", "p.role")


def either(df: DataFrame, *candidates: str) -> Column:
    """The first of the columns that the frame has."""
    for c in candidates:
        if c in df.columns:
            return F.col(c)
    raise ValueError(f"none of {candidates} in {df.columns}")


def triples(df: DataFrame) -> DataFrame:
    """(seq, actor, action, target, doc_id) whatever the columns are called; rows without an end are dropped."""
    seq = either(df, "seq", "id") if {"seq", "id"} & set(df.columns) else F.monotonically_increasing_id()
    out = df.select(seq.alias("seq"), either(df, "actor", "subject").alias("actor"), F.col("action"), either(df, "target", "object").alias("target"), F.col("doc_id").cast("string").alias("doc_id"))
    return out.where("actor is not null and target is not null")


def extracted_names(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", schemas.EXTRACTED_NAMES).alias("r"))
    return whole.select(F.posexplode("r.names").alias("pos", "n")).select("pos", "n.entity_value", "n.document_count", "n.efta_numbers")


def csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header as text columns, empty where the file is missing."""
    if not available(spark, path, 1):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return spark.read.csv(path, header=True)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """``df`` in a table's columns; those it lacks are null (additive evolution)."""
    from pyspark.sql.types import _parse_datatype_string

    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in _parse_datatype_string(schema)))
