"""Finding heavy keys and joining around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.session import written


def heavy_keys(
    df: DataFrame, key: str, settings: Settings = DEFAULTS, pieces: str | None = None
) -> DataFrame:
    """Keys with more rows than one task should hold.

    Every such key comes back; how the list is joined is left to its size. The
    column ``pieces`` says into how many parts a key's rows are to be split.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > settings.hot_group_rows)
        .select(key, *([F.ceil(F.col("_rows") / settings.hot_group_rows).alias(pieces)] if pieces else []))
    )


def fits_broadcast(df: DataFrame, settings: Settings = DEFAULTS) -> bool:
    """Whether ``df`` has at most ``max_broadcast_rows`` rows; stops counting there."""
    limit = settings.max_broadcast_rows
    return df.limit(limit + 1).count() <= limit


def join_small(big: DataFrame, small: DataFrame, key: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Inner join on a unique key; ``small`` is broadcast if its row count allows."""
    if fits_broadcast(small.select(key), settings):
        small = F.broadcast(small)
    return big.join(small, key)


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Column,
    settings: Settings = DEFAULTS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Left join of facts with a table that has one row per key.

    A dimension small enough, by count, is broadcast. Otherwise both sides are
    shuffled; rows of a heavy key are split into as many parts as their number
    asks for, and only the heavy dimension rows are copied. Rows without a key
    match nothing and are spread at will.
    Heavy keys are counted on ``count_on`` if given: a table with the keys of
    ``facts`` that is cheaper to read.
    """
    if fits_broadcast(dimension.select(key), settings):
        return facts.join(F.broadcast(dimension), key, "left")

    counted = facts if count_on is None else count_on
    heavy = written(heavy_keys(counted, key, settings, "_pieces"), "heavy-keys")
    spread = F.xxhash64(spread_by)
    salted_facts = facts.join(heavy, key, "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), spread)
        .when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces")))
        .otherwise(F.lit(0).cast("long")),
    )
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)
    salted_dimension = (
        dimension.join(heavy, key, "left").withColumn("_salt", F.explode(copies)).drop("_pieces")
    )
    return salted_facts.drop("_pieces").join(salted_dimension, [key, "_salt"], "left").drop("_salt")


