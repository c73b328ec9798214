"""Insert or replace rows by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.sources.tables import VersionedTable, partition_value


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` replacing rows of the same key.

    The batch must hold each key once (see ``require_unique``).
    """
    untouched = target.join(batch.select(*keys), keys, "left_anti")
    return untouched.select(*target.columns).unionByName(batch.select(*target.columns))


def require_unique(batch: DataFrame, keys: list[str]) -> None:
    """Refuse a batch that would update one row twice."""
    named = batch.dropna(subset=keys)  # a null key equals no other
    repeated = named.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"batch has several rows for {[repeated[0][k] for k in keys]} of {keys}")


def upsert_into(
    table: VersionedTable, batch: DataFrame, keys: list[str], keys_move: bool = True
) -> int:
    """Upsert into a stored table, rewriting only partitions that hold a batch key.

    A key may have moved to another partition, so the partitions to rewrite are
    found by key over the whole table; that pass reads the key columns only. If
    the partition value of a key never changes, ``keys_move=False`` saves it.
    """
    require_unique(batch, keys)
    part = table.partition
    touched = batch.select(part).distinct()
    if keys_move and part not in keys:
        hit = table.read().select(*keys, part).join(batch.select(*keys), keys, "left_semi")
        touched = touched.union(hit.select(part)).distinct()
    # one value per partition folder
    values = [partition_value(row[0]) for row in touched.collect()]
    return table.replace(upsert(table.read(values=values), batch, keys), values)
