"""Document references that keep arriving: the crosswalk is upserted batch by batch."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import docids

PARTS = 64


class Crosswalk:
    """(doc_key, efta, ogr, raw_id, seq) as Parquet, in parts by the key's hash.

    A batch writes only the parts it touches, under its own number; readers see the last complete batch of each part.
    What is there is found in the folder, so a new object, or a restarted stream, goes on where the last one ended. A
    batch reads only earlier ones, so one that is delivered again writes the same rows again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = "doc_key string, efta string, ogr string, raw_id string, seq bigint"

    def _listed(self, path: str) -> list[str]:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []

    def batches(self) -> list[int]:
        """The complete batches, in order."""
        found = [int(m[1]) for x in self._listed(self.root) if (m := re.fullmatch(r"batch=(\d+)", x))]
        return sorted(n for n in found if "_SUCCESS" in self._listed(f"{self.root}/batch={n}"))

    @property
    def batch(self) -> int:
        """The last complete batch, -1 before the first."""
        return max(self.batches(), default=-1)

    def read(self, before: int | None = None, parts: list[int] | None = None) -> DataFrame:
        """All rows, as of the batches before a number; of some parts only, if they are given."""
        last: dict[int, int] = {}
        for n in self.batches():
            if before is None or n < before:
                last |= {int(m[1]): n for x in self._listed(f"{self.root}/batch={n}") if (m := re.fullmatch(r"part=(\d+)", x))}
        paths = [f"{self.root}/batch={n}/part={k}" for k, n in sorted(last.items()) if parts is None or k in parts]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def upsert(self, refs: DataFrame, batch: int) -> None:
        """Merges references (raw, seq): of each column the last value that is not null."""
        keyed = docids.canonicalize(refs, ["raw"])
        links = docids.crosswalk(keyed.select("efta", "ogr", "seq").unionByName(self.read(batch).select("efta", "ogr", "seq")))
        part = F.pmod(F.xxhash64("doc_key"), F.lit(PARTS)).cast("int").alias("part")
        new = docids.canonicalize(refs, ["raw"], links).select("doc_key", "efta", "ogr", "raw_id", "seq")
        touched = [r.part for r in new.select(part).distinct().collect()]  # PARTS rows at most
        rows = new.unionByName(self.read(batch, touched))
        last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
        merged = rows.groupBy("doc_key").agg(last("efta"), last("ogr"), last("raw_id"), F.max("seq").alias("seq"))
        merged.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/batch={batch}")

    def start(self, refs: DataFrame, checkpoint: str) -> StreamingQuery:
        """Runs over a stream of references until what is available is read."""
        return refs.writeStream.foreachBatch(self.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
