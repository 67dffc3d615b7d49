"""Sharding by fixed virtual slots and a versioned slot-to-shard map. Native DataFrame operations only.

Records are hashed into ``slots`` slots by their text, so equal texts share a slot and a shard. Only a group of
equal texts with more than ``whole`` times a shard's even share of the bytes (at ``whole`` = 1, fewer such groups than
shards exist), which no shard could hold without being too large, is spread over all slots; column ``spread`` tells
which. Bytes are summed per slot, and the slot-to-shard map is edited: slots move from the fullest to the emptiest
shard until the sizes are near equal. The map lives in ``folder``, a table of ``slots`` rows for each version: a run
loads the latest one, or begins with slot modulo shards, edits it and adds a version; none is ever overwritten. A
map of fewer shards than asked for first grows, shard by shard, taking slots into the new one only. The driver
sees sums by slot, never records.

Defined results: a null text counts as empty, size 1; null or repeated ids are records like any other;
an empty table gives no rows and the unedited map; other columns are ignored.
"""

from __future__ import annotations

import bisect
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._frames import shared_folder, written

SLOTS = 4096
SHARDS = 16
TOLERANCE = 1e-4
#: A group of equal texts is kept whole up to this multiple of a shard's even share.
WHOLE = 1.0
#: Parts of a slot, so that records of a slot are numbered by several tasks.
PARTS = 16


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot; ``version`` grows with each edit."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @classmethod
    def first(cls, slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
        return cls(1, shards, tuple(s % shards for s in range(slots)))

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, virtual_slot, shard): a row per slot."""
        listed = F.split(F.lit(",".join(map(str, self.owner))), ",")
        return spark.range(1).select(F.lit(self.version).alias("version"), F.posexplode(listed).alias("virtual_slot", "s")).select("version", "virtual_slot", F.col("s").cast("int").alias("shard"))

    def store(self, spark: SparkSession, folder: str) -> DataFrame:
        """Adds this version; fails if there is one of its number already."""
        path = f"{folder}/version={self.version}"
        self.frame(spark).drop("version").coalesce(1).write.mode("error").parquet(path)
        return spark.read.schema("virtual_slot int, shard int").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> SlotMap | None:
        """The latest complete version in ``folder``, or None."""
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return None
        found = [x.getPath().getName() for x in fs.listStatus(at)]
        found = [int(x.split("=")[1]) for x in found if x.startswith("version=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{x}/_SUCCESS"))]
        if not found:
            return None
        rows = spark.read.schema("virtual_slot int, shard int").parquet(f"{folder}/version={max(found)}").orderBy("virtual_slot").collect()  # a row per slot
        return cls(max(found), max(r.shard for r in rows) + 1, tuple(r.shard for r in rows))

    def rebalanced(self, size: list[int], tolerance: float = TOLERANCE) -> SlotMap:
        """The next version: single slots move from fuller to emptier shards while that narrows their gap."""
        held: list[list[tuple[int, int]]] = [sorted((size[s], s) for s, o in enumerate(self.owner) if o == k and size[s]) for k in range(self.shards)]
        load = [sum(b for b, _ in x) for x in held]
        aim = tolerance * sum(load) / self.shards
        owner = list(self.owner)
        for _ in range(4 * len(owner)):
            low = min(range(self.shards), key=lambda k: (load[k], k))
            move = None
            for high in sorted(range(self.shards), key=lambda k: (-load[k], k)):
                gap = load[high] - load[low]
                if gap <= aim or gap < 2:
                    break
                at = bisect.bisect_right(held[high], (gap // 2, len(owner)))
                near = [x for x in held[high][max(0, at - 1) : at + 1] if x[0] < gap]
                if near:
                    move = (high, min(near, key=lambda x: abs(gap - 2 * x[0])))
                    break
            if move is None:
                break
            high, (b, s) = move
            held[high].remove((b, s))
            bisect.insort(held[low], (b, s))
            load[high], load[low], owner[s] = load[high] - b, load[low] + b, low
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def grown(self, size: list[int]) -> SlotMap:
        """The next version with one more shard: slots move only into it, until it holds its share of bytes."""
        new, share = self.shards, sum(size) / (self.shards + 1)
        owner, load = list(self.owner), [0] * (self.shards + 1)
        for s, o in enumerate(owner):
            load[o] += size[s]
        held: list[list[tuple[int, int]]] = [sorted((size[s], s) for s, o in enumerate(owner) if o == k) for k in range(self.shards)]
        while load[new] < share:
            high = max(range(self.shards), key=lambda k: (load[k], -k))
            room = share - load[new]
            at = bisect.bisect_right(held[high], (room, len(owner)))
            if not at or not held[high][at - 1][0]:
                break
            b, s = held[high].pop(at - 1)
            owner[s], load[high], load[new] = new, load[high] - b, load[new] + b
        return SlotMap(self.version + 1, self.shards + 1, tuple(owner))


def hashed(docs: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS, shards: int = SHARDS, whole: float = WHOLE) -> DataFrame:
    """Records with ``size``, ``text_crc32``, ``spread``, ``virtual_slot`` and ``part``."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), id, (F.octet_length(content).cast("long") + 1).alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"), F.xxhash64(content).alias("group"))
    rows = written(rows, "sharding-records")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > whole * total / shards) & (F.col("n") > 1))
    large = [r.group for r in groups.collect()]  # fewer than shards / whole rows
    spread = F.col("group").isin(large) if large else F.lit(False)
    key = F.when(spread, F.xxhash64("row")).otherwise(F.col("group"))
    return rows.select(id, "row", "size", "text_crc32", spread.alias("spread"), F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("virtual_slot"), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(PARTS)).cast("int").alias("part"))


def shard(docs: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS, shards: int = SHARDS, folder: str | None = None, whole: float = WHOLE) -> DataFrame:
    """One row per row of ``docs`` under the law ``bytes``; ``slot`` numbers a shard's records from 0.

    ``folder`` holds the map's versions from run to run; without one the map is new.
    """
    spark = docs.sparkSession
    records = hashed(docs, id, text, slots, shards, whole)
    cells = written(records.groupBy("virtual_slot", "part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "sharding-cells")  # slots * PARTS rows at most
    size = [0] * slots
    for r in cells.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes")).collect():
        size[r.virtual_slot] = r.bytes
    folder = folder or f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    current = SlotMap.load(spark, folder)
    if current is None:
        current = SlotMap.first(slots, shards)
        current.store(spark, folder)
    if len(current.owner) != slots or current.shards > shards:
        raise ValueError(f"the map in {folder} has {len(current.owner)} slots and {current.shards} shards")
    while current.shards < shards:
        current = current.grown(size)
        current.store(spark, folder)
    current = current.rebalanced(size)
    owner = current.store(spark, folder)
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    places = cells.join(F.broadcast(owner), "virtual_slot").select("virtual_slot", "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("virtual_slot", "part").orderBy("row")
    return (
        records.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(places), ["virtual_slot", "part"])
        .select(id, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(current.version).alias("map_version"), "spread")
    )
