"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    A session that leaves it unset gets a folder of its own on a single machine; on a cluster that is an error, as
    each node would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_made: dict[int, str] = {}


def written(df: DataFrame, name: str, sort_in: list[str] | None = None) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    This cuts the lineage: a lost executor costs no recomputation of what is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort_in) if sort_in else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _made[id(out)] = path
    weakref.finalize(out, _made.pop, id(out), None)
    return out


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(table: DataFrame | None) -> None:
    """Removes the files of a table that ``written`` returned; nothing may read it any more."""
    path = _made.pop(id(table), None) if table is not None else None
    if path:
        remove(table.sparkSession, path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _give_back() -> None:
    """Returns freed memory to the machine, which an idle worker would hold while the next stage runs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(
    df: DataFrame,
    columns: list[str],
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
) -> DataFrame:
    """``mapInArrow`` with per-task state: ``make()`` runs once in a task, its result once for each batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield from step(batch)
        rest = getattr(step, "finish", None)
        if rest is not None:
            yield from rest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        _give_back()

    return df.select(*columns).mapInArrow(run, schema)
