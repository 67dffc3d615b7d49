"""Timelines and volume anomalies. Dates stay text; a month is its first seven characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config

S, T = "source_entity_id", "target_entity_id"


def month(c: Column) -> Column:
    return F.substring(c, 1, 7)


def events_table(spark: SparkSession, events: dict[str, str] | None = None) -> DataFrame:
    """(month, event): a row per configured month."""
    known = events if events is not None else config.KEY_EVENTS
    base = spark.range(1)
    if not known:
        return base.where("false").select(F.lit("").alias("month"), F.lit("").alias("event"))
    return base.select(F.explode(F.create_map(*(F.lit(x) for p in known.items() for x in p))).alias("month", "event"))


def relationship_timeline(edges: DataFrame, entities: DataFrame, events: DataFrame) -> DataFrame:
    """Dated relationships with the names of both ends and the event of their month."""
    dated = edges.where("date_start is not null or date_end is not null").withColumn("month", month(F.coalesce("date_start", "date_end")))
    name = lambda end, out: entities.select(F.col("canonical_id").alias(end), F.col("canonical_name").alias(out))
    joined = dated.join(name(S, "source_name"), S).join(name(T, "target_name"), T).join(F.broadcast(events), "month", "left")  # a configured list
    return joined.select("relationship_id", "source_name", "target_name", "relationship_type", "date_start", "date_end", F.coalesce("event", F.lit("")).alias("nearby_event"))


def volume_anomalies(rows: DataFrame, period: str, events: DataFrame | None = None, sigmas: float = 2.0) -> DataFrame:
    """Periods with more rows than the mean plus ``sigmas`` population deviations of all periods."""
    counts = rows.where(F.col(period).isNotNull()).groupBy(F.col(period).alias("period")).agg(F.count("*").alias("n"))
    level = counts.agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("deviation"))  # one row
    out = counts.crossJoin(F.broadcast(level)).withColumn("threshold", F.col("mean") + sigmas * F.col("deviation")).where("n > threshold")
    out = out.withColumn("description", F.format_string("%d documents (avg %.1f)", "n", "mean"))
    if events is not None:
        out = out.join(F.broadcast(events.select(F.col("month").alias("period"), "event")), "period", "left")
    return out
