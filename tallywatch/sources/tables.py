"""Parquet outputs: create, overwrite, and versioned tables for upserts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import child_names


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, ddl: str, comment: str = "") -> None:
    """Create an empty parquet table with a fixed schema unless it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet COMMENT '{comment}'")


def overwrite_table(df: DataFrame, name: str, comment: str = "", quality: str = "") -> None:
    """Replace a catalog table, with its comment and quality tag."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{comment}'")
    if quality:
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = '{quality}')")


def partition_value(value) -> str:
    """Name of a partition: the value as text, before the folder name escapes it."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


@dataclass(frozen=True)
class VersionedTable:
    """A parquet table that is replaced partition by partition.

    A change writes the new partitions to a folder of their own, then a small
    pointer file that names the folder of every partition. Readers follow one
    pointer file, so they see a whole version.
    One writer at a time.
    """

    spark: SparkSession
    path: str
    ddl: str
    partition: str

    def latest(self) -> int:
        """Newest version; 0 before the first change."""
        done = [
            int(name.split("=")[1])
            for name in child_names(self.spark, f"{self.path}/_pointers")
            if "_SUCCESS" in child_names(self.spark, f"{self.path}/_pointers/{name}")
        ]
        return max(done, default=0)

    def _pointers(self, version: int) -> dict[str, str]:
        """Folder by partition value: one entry per partition, whatever the row count."""
        if version == 0:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/_pointers/version={version}").collect()
        return {row["value"]: row["folder"] for row in rows}

    def partitions(self) -> list[str]:
        return sorted(self._pointers(self.latest()))

    def read(self, values: list[str] | None = None) -> DataFrame:
        """The table, or only the given partitions of it."""
        pointers = self._pointers(self.latest())
        wanted = pointers if values is None else {v: pointers[v] for v in values if v in pointers}
        empty = self.spark.createDataFrame([], self.ddl)
        if not wanted:
            return empty
        folders = [f"{self.path}/{folder}" for _, folder in sorted(wanted.items())]
        kind = empty.schema[self.partition].dataType
        return (
            self.spark.read.schema(empty.schema)
            .option("basePath", self.path)
            .parquet(*folders)
            .withColumn(self.partition, F.col(self.partition).cast(kind))
            .select(*empty.columns)
        )

    def replace(self, df: DataFrame, values: list[str]) -> int:
        """Make ``df`` the whole content of the partitions ``values``; returns the version."""
        current = self.latest()
        folder = f"change={uuid.uuid4().hex[:12]}"
        # rebalancing keeps small partitions whole and lets Spark split large ones
        df.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(
            f"{self.path}/{folder}"
        )
        written = {
            unquote(name.split("=", 1)[1]): f"{folder}/{name}"
            for name in child_names(self.spark, f"{self.path}/{folder}")
            if name.startswith(f"{self.partition}=")
        }
        if not set(written) <= set(values):
            raise ValueError(f"rows outside the replaced partitions: {sorted(set(written) - set(values))[:5]}")
        pointers = {v: f for v, f in self._pointers(current).items() if v not in values}
        pointers.update(written)
        rows = [(value, target) for value, target in sorted(pointers.items())]
        self.spark.createDataFrame(rows, "value string, folder string").coalesce(1).write.mode(
            "errorifexists"
        ).parquet(f"{self.path}/_pointers/version={current + 1}")
        return current + 1
