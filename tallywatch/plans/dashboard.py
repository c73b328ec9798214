"""Report queries over the Gold, Silver, prediction and monitoring tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.functions.expressions import ratio, stable_round
from tallywatch.operators.scoring import latest_date, on_date
from tallywatch.operators.skew import join_small


def daily_volumes(daily: DataFrame) -> DataFrame:
    columns = ["txn_count", "total_amount", "fraud_count", "fraud_amount", "fraud_rate_pct"]
    return daily.select("txn_date", *columns).orderBy("txn_date")


def headline(daily: DataFrame) -> DataFrame:
    """Counters of the latest date."""
    latest = daily.orderBy(F.desc("txn_date")).limit(1)
    return latest.select("txn_count", "fraud_count", "fraud_amount", "active_customers")


def _on_latest_date(preds: DataFrame) -> DataFrame:
    latest = latest_date(preds)
    return preds.limit(0) if latest is None else on_date(preds, latest)


def review_queue(preds: DataFrame, silver: DataFrame) -> DataFrame:
    """Alerts of the latest date, best score first."""
    alerts = _on_latest_date(preds).where("is_alert = 1")
    details = silver.select("transaction_id", "merchant_id", "merchant_category", "country", "channel")
    return (
        join_small(details, alerts, "transaction_id")
        .orderBy(F.desc("fraud_score"), "transaction_id")
        .select(
            "transaction_id",
            "event_ts",
            "customer_id",
            "amount",
            stable_round(F.col("fraud_score"), 3).alias("fraud_score"),
            "merchant_id",
            "merchant_category",
            "country",
            "channel",
        )
    )


def incidence_by_category(merchants: DataFrame) -> DataFrame:
    rate = ratio(F.sum("fraud_count") * 100.0, F.sum("txn_count"))
    return (
        merchants.groupBy("merchant_category")
        .agg(F.sum("fraud_count").alias("fraud_count"), stable_round(rate, 3).alias("fraud_rate_pct"))
        .orderBy(F.desc("fraud_rate_pct"), "merchant_category")
    )


def riskiest_merchants(merchants: DataFrame, settings: Settings = DEFAULTS, top: int = 20) -> DataFrame:
    return (
        merchants.where(F.col("txn_count") >= settings.min_merchant_volume)
        .orderBy(F.desc("fraud_rate_pct"), "merchant_id", "merchant_category")
        .limit(top)
        .select(
            "merchant_id", "merchant_category", "txn_count", "avg_amount", "fraud_count", "fraud_rate_pct"
        )
    )


def pattern_mix(silver: DataFrame) -> DataFrame:
    return (
        silver.where("is_fraud = 1")
        .groupBy(F.to_date("event_ts").alias("txn_date"), "fraud_type")
        .agg(F.count("*").alias("fraud_txns"))
        .orderBy("txn_date", "fraud_type")
    )


def hourly_heatmap(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.hour("event_ts").alias("hour_of_day"), "channel")
        .agg(
            F.count("*").alias("txns"),
            stable_round(F.avg("is_fraud") * 100, 3).alias("fraud_rate_pct"),
        )
        .orderBy("hour_of_day", "channel")
    )


def quarantine_trend(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy(F.to_date("_ingested_at").alias("ingest_date"), "_quarantine_reason")
        .agg(F.count("*").alias("rejected_rows"))
        .orderBy("ingest_date", "_quarantine_reason")
    )


def quarantine_on(rejected: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Reasons of one ingest day; today if none is given."""
    wanted = F.current_date() if day is None else F.lit(day)
    return (
        rejected.where(F.to_date("_ingested_at") == wanted)
        .groupBy("_quarantine_reason")
        .agg(F.count("*").alias("rejected_rows"))
    )


def reconciliation(bronze: DataFrame, silver: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of the three layers side by side."""
    layers = {"bronze_rows": bronze, "silver_rows": silver, "quarantined_rows": rejected}
    counts = [df.select(F.count("*")).scalar().alias(name) for name, df in layers.items()]
    return bronze.sparkSession.range(1).select(*counts)


def health_trend(monitoring: DataFrame) -> DataFrame:
    return monitoring.select(
        "monitor_date",
        "model_version",
        "psi",
        "alert_count",
        stable_round(F.col("alert_precision"), 3).alias("alert_precision"),
        stable_round(F.col("fraud_recall"), 3).alias("fraud_recall"),
    ).orderBy("monitor_date", "model_version")


def score_distribution(preds: DataFrame) -> DataFrame:
    """Rows per tenth of the score on the latest date; a score of 1 has its own bucket."""
    bucket = F.round(F.floor(F.col("fraud_score") * 10) / 10, 1)
    return (
        _on_latest_date(preds)
        .groupBy(bucket.alias("score_bucket"))
        .agg(F.count("*").alias("txns"))
        .orderBy("score_bucket")
    )


def missed_fraud(silver: DataFrame, preds: DataFrame, top: int = 50) -> DataFrame:
    """Latest fraud that raised no alert."""
    quiet = preds.where("is_alert = 0").select("transaction_id", "fraud_score")
    return (
        silver.where("is_fraud = 1")
        .select("transaction_id", "event_ts", "customer_id", "amount", "fraud_type")
        .join(quiet, "transaction_id")
        .orderBy(F.desc("event_ts"), "transaction_id")
        .limit(top)
        .withColumn("fraud_score", stable_round(F.col("fraud_score"), 3))
    )


def fraud_amount_by_month(facts: DataFrame, dates: DataFrame, merchants: DataFrame) -> DataFrame:
    """Star join: fraud amount by calendar month and merchant category.

    Facts are summed per date and merchant key before the joins, so the joins
    see one row per pair instead of every transaction.
    """
    per_key = (
        facts.where("is_fraud = 1")
        .groupBy("date_key", "merchant_key")
        .agg(F.sum("amount").alias("fraud_amount"))
    )
    return (
        per_key.join(dates.select("date_key", "month"), "date_key")
        .join(merchants.select("merchant_key", "category"), "merchant_key")
        .groupBy("month", "category")
        .agg(stable_round(F.sum("fraud_amount"), 2).alias("fraud_amount"))
    )


def star_schema(silver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, date and merchant tables of the star over the clean table.

    A merchant has one row, with the category of its latest transaction. Facts
    without a merchant meet no row of it, as in any inner join.
    """
    date_key = F.date_format("event_ts", "yyyyMMdd").cast("int").alias("date_key")
    facts = silver.select(date_key, F.col("merchant_id").alias("merchant_key"), "amount", "is_fraud")
    dates = silver.select(date_key, F.date_format("event_ts", "yyyy-MM").alias("month")).distinct()
    merchants = silver.groupBy(F.col("merchant_id").alias("merchant_key")).agg(
        F.max_by("merchant_category", F.struct("event_ts", "merchant_category")).alias("category")
    )
    return facts, dates, merchants
