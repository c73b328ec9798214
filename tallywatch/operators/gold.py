"""Aggregates for reporting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.expressions import ratio, stable_round

NIGHT_END_HOUR = 6
MERCHANT = ("merchant_id", "merchant_category")
FOOTPRINT = ("customer_id", "country", "device_id")


def daily_kpis(silver: DataFrame) -> DataFrame:
    """Volumes, exposure and active customers per day.

    Rows are first reduced to one per day and customer, which gives the distinct
    count without expanding the input and spreads a busy day over the cluster.
    """
    per_customer = silver.groupBy(F.to_date("event_ts").alias("txn_date"), "customer_id").agg(
        F.count("*").alias("n"),
        F.count("is_fraud").alias("labelled"),
        F.sum("amount").alias("amount"),
        F.sum("is_fraud").alias("frauds"),
        F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(0.0)).alias("fraud_amount"),
    )
    return per_customer.groupBy("txn_date").agg(
        F.sum("n").alias("txn_count"),
        stable_round(F.sum("amount"), 2).alias("total_amount"),
        F.sum("frauds").alias("fraud_count"),
        stable_round(F.sum("fraud_amount"), 2).alias("fraud_amount"),
        stable_round(ratio(F.sum("frauds"), F.sum("labelled")) * 100, 4).alias("fraud_rate_pct"),
        F.count("customer_id").alias("active_customers"),
    )


def merchant_stats(silver: DataFrame) -> DataFrame:
    """Volumes and incidence per merchant; rows without a merchant form one group."""
    return merchant_rates(merchant_totals(silver))


def merchant_totals(silver: DataFrame) -> DataFrame:
    """Sums per merchant that can be added to those of other rows."""
    return silver.groupBy(*MERCHANT).agg(
        F.count("*").alias("n"),
        F.count("amount").alias("priced"),
        F.sum("amount").alias("amount"),
        F.count("is_fraud").alias("labelled"),
        F.sum("is_fraud").alias("frauds"),
    )


def merchant_rates(totals: DataFrame) -> DataFrame:
    return totals.select(
        *MERCHANT,
        F.col("n").alias("txn_count"),
        stable_round(ratio(F.col("amount"), F.col("priced")), 2).alias("avg_amount"),
        F.col("frauds").alias("fraud_count"),
        stable_round(ratio(F.col("frauds"), F.col("labelled")) * 100, 4).alias("fraud_rate_pct"),
    )


def merge_merchants(old: DataFrame, new: DataFrame) -> DataFrame:
    """Totals of two disjoint sets of rows as those of their union."""
    sums = {name: _added(name) for name in ("n", "priced", "amount", "labelled", "frauds")}
    return _matched(old, new, MERCHANT, sums)


def customer_profiles(silver: DataFrame) -> DataFrame:
    """Spend, geography and device footprint per customer.

    Two exact distinct counts in one aggregate would triple the input. Reducing
    to (customer, country, device) first does the heavy shuffle once, on partial
    sums; the spread is merged from group variances and the groups' distances from
    the customer's mean, so large amounts with a small spread keep their digits.
    """
    return footprint_profiles(customer_footprints(silver))


def customer_footprints(silver: DataFrame) -> DataFrame:
    """One row per customer, country and device, which can be merged with those of other rows."""
    night = F.hour("event_ts") < NIGHT_END_HOUR
    return silver.groupBy(*FOOTPRINT).agg(
        F.count("*").alias("n"),
        F.count("amount").alias("priced"),
        F.sum("amount").alias("amount"),
        F.avg("amount").alias("mean"),
        F.var_pop("amount").alias("variance"),
        F.count_if(night).alias("night"),
        F.count("event_ts").alias("timed"),
        F.max("event_ts").alias("last_seen_ts"),
    )


def footprint_profiles(footprint: DataFrame) -> DataFrame:
    # one row per country and device, partitioned as the aggregate below needs it
    customer = Window.partitionBy("customer_id")
    centre = ratio(F.sum(F.col("mean") * F.col("priced")).over(customer), F.sum("priced").over(customer))
    off = F.col("mean") - F.col("centre")
    spread = F.sum(F.col("priced") * (F.col("variance") + off * off))
    return footprint.withColumn("centre", centre).groupBy("customer_id").agg(
        F.sum("n").alias("txn_count"),
        stable_round(ratio(F.sum("amount"), F.sum("priced")), 2).alias("avg_amount"),
        stable_round(F.sqrt(ratio(spread, F.sum("priced") - 1)), 2).alias("std_amount"),
        F.countDistinct("country").alias("distinct_countries"),
        F.countDistinct("device_id").alias("distinct_devices"),
        stable_round(ratio(F.sum("night"), F.sum("timed")), 4).alias("night_txn_ratio"),
        F.max("last_seen_ts").alias("last_seen_ts"),
    )


def merge_footprints(old: DataFrame, new: DataFrame) -> DataFrame:
    """Footprints of two disjoint sets of rows as those of their union.

    Means and variances are merged pairwise: the variance of the union is the weighted
    mean of both plus what the distance of their means adds.
    """
    zero = F.lit(0)
    a, b = F.coalesce(F.col("a.priced"), zero), F.coalesce(F.col("b.priced"), zero)
    weighted = lambda name: F.coalesce(F.col(f"a.{name}") * a, zero) + F.coalesce(F.col(f"b.{name}") * b, zero)
    apart = F.coalesce(F.col("a.mean") - F.col("b.mean"), zero)
    merged = {name: _added(name) for name in ("n", "priced", "amount")} | {
        "mean": ratio(weighted("mean"), a + b),
        "variance": ratio(weighted("variance"), a + b) + apart * apart * ratio(a, a + b) * ratio(b, a + b),
        "night": _added("night"),
        "timed": _added("timed"),
        "last_seen_ts": F.greatest("a.last_seen_ts", "b.last_seen_ts"),
    }
    return _matched(old, new, FOOTPRINT, merged)


def _added(name: str) -> Column:
    """Sum of both sides, of one where the other has no value."""
    old, new = F.col(f"a.{name}"), F.col(f"b.{name}")
    return F.coalesce(old + new, old, new)


def _matched(old: DataFrame, new: DataFrame, keys: tuple[str, ...], merged: dict[str, Column]) -> DataFrame:
    """Each side holds a key, nulls included, at most once, so the join has no heavy key."""
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = old.alias("a").join(new.alias("b"), same, "full_outer")
    return both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], *[c.alias(name) for name, c in merged.items()])
