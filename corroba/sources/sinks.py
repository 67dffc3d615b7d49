"""Sinks: versioned tables, CSV files, the Markdown summary, the run log."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .readers import conform


class Store:
    """The unified tables as Parquet under one folder.

    ``write`` makes a new version of a table, ``append`` adds files to the last one; readers see the last complete
    version with what was added. Versions are found in the folder, so a new object sees what an earlier one wrote.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.version, self.added = spark, root.rstrip("/"), {}, {}
        for name in schemas.TABLES:
            found = [int(x[1:]) for x in self._listed(f"{self.root}/{name}") if x[1:].isdigit() and "_SUCCESS" in self._listed(f"{self.root}/{name}/{x}/0")]
            if found:
                self.version[name] = max(found)
                more = [int(x) for x in self._listed(f"{self.root}/{name}/v{max(found)}") if "_SUCCESS" in self._listed(f"{self.root}/{name}/v{max(found)}/{x}")]
                self.added[name] = sorted(more)

    def _listed(self, path: str) -> list[str]:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []

    def create(self) -> Store:
        for name, schema in schemas.TABLES.items():
            self.write(name, self.spark.createDataFrame([], schema))
        return self

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/v{self.version[name]}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.TABLES[name]).parquet(*(f"{self.path(name)}/{k}" for k in self.added[name]))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in self.version}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        at = self.version.get(name, 0) + 1
        conform(df, schemas.TABLES[name]).write.mode("overwrite").parquet(f"{self.root}/{name}/v{at}/0")
        self.version[name], self.added[name] = at, [0]
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        at = self.added[name][-1] + 1
        conform(df, schemas.TABLES[name]).write.mode("overwrite").parquet(f"{self.path(name)}/{at}")
        self.added[name].append(at)
        return self.read(name)

    def log_run(self, step: str, status: str, records: int | None = None, notes: str | None = None, started: str | None = None) -> None:
        now = now_iso()
        row = [(step, started or now, now, status, records, notes)]
        self.append("pipeline_runs", self.spark.createDataFrame(row, schemas.PIPELINE_RUNS))

    def summary(self) -> DataFrame:
        """(table, rows)."""
        out = None
        for name in sorted(self.version):
            one = self.read(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
            out = one if out is None else out.unionByName(one)
        return out


def now_iso() -> str:
    return datetime.now(UTC).isoformat()


def write_csv(df: DataFrame, path: str, always: bool = True, single: bool = False) -> bool:
    """CSV files with a header, in the frame's order; with ``always`` off only where there are rows. Arrays are joined by semicolons.

    ``single`` makes one file; only for results of a bounded size.
    """
    if not always and not df.head(1):
        return False
    flat = df.select(*(F.array_join(F.col(n), "; ").alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes))
    (flat.coalesce(1) if single else flat).write.mode("overwrite").option("header", True).csv(path)
    return True


def markdown_summary(rows: DataFrame, title: str = "Research priorities", n: int = 50) -> str:
    """A table of the ``n`` highest priorities."""
    lines = [f"# {title}", "", "| Rank | Entity | Score | Factors |", "|---|---|---|---|"]
    for i, r in enumerate(rows.orderBy(F.desc("priority_score"), "canonical_name").limit(n).collect(), 1):
        lines.append(f"| {i} | {r.canonical_name} | {r.priority_score:.1f} | {r.factors} |")
    return "\n".join([*lines, ""])


def catalog_tables(spark: SparkSession) -> list[tuple[str, str]]:
    return sorted((t.name, t.tableType) for t in spark.catalog.listTables())
