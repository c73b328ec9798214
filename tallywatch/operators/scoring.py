"""Scoring a day of transactions and choosing the alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.operators.dates import between_dates, on_date
from tallywatch.operators.daystate import DayStates, day_features
from tallywatch.operators.features import build_features
from tallywatch.session import written

PREDICTIONS_DDL = (
    "transaction_id STRING, event_ts TIMESTAMP, customer_id STRING, amount DOUBLE, "
    "fraud_score DOUBLE, is_alert INT, model_version INT, scored_at TIMESTAMP"
)
Scorer = Callable[[DataFrame], DataFrame]


def latest_date(rows: DataFrame) -> dt.date | None:
    """The latest event date, from the date partition if there is one.

    It comes back as a value, not a subquery, so that filters built on it reach
    the scan and prune partitions.
    """
    column = "event_date" if "event_date" in rows.columns else "event_ts"
    return rows.select(F.to_date(F.max(column))).first()[0]


def resolve_date(rows: DataFrame, date: str = "auto") -> dt.date:
    """An explicit date, or the latest date in ``rows``."""
    if date != "auto":
        return dt.date.fromisoformat(date)
    latest = latest_date(rows)
    if latest is None:
        raise ValueError("no transactions to take the latest date from")
    return latest


def scoring_features(
    txns: DataFrame, risk: DataFrame, date: dt.date, settings: Settings = DEFAULTS
) -> DataFrame:
    """Features of the rows of one day, from ``lookback_days`` of history.

    ``lookback_days=None`` uses all history, as training does.
    """
    days = settings.lookback_days
    after = None if days is None else date - dt.timedelta(days=days)
    return on_date(build_features(between_dates(txns, after, date), risk, settings), date)


def flag_alerts(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``is_alert``: above the threshold and within the budget of its day.

    Only rows above the threshold are ranked, and the rank filter keeps a
    budget's worth per map task, so a day is never sorted in one task. What is
    joined back is the last alert of each day, one small row per day; rows are
    compared with it in place. ``scored`` is read twice; give it a table.
    """
    alarming = F.col("fraud_score") >= settings.alert_threshold
    best = Window.partitionBy("_day").orderBy(F.desc("fraud_score"), "transaction_id")
    dated = scored.withColumn("_day", F.to_date("event_ts"))
    last_alerts = (
        dated.where(alarming)
        .select("_day", "fraud_score", "transaction_id")
        .withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= settings.max_daily_alerts)
        .groupBy("_day")
        .agg(F.max_by(F.struct("fraud_score", "transaction_id"), "_rank").alias("_last"))
    )
    within = (F.col("fraud_score") > F.col("_last.fraud_score")) | (
        (F.col("fraud_score") == F.col("_last.fraud_score"))
        & (F.col("transaction_id") <= F.col("_last.transaction_id"))
    )
    # a row per calendar day: some 36,500 in a century
    return (
        dated.join(F.broadcast(last_alerts), "_day", "left")
        .withColumn("is_alert", F.coalesce((alarming & within).cast("int"), F.lit(0)))
        .drop("_day", "_last")
    )


def batch_score(
    txns: DataFrame,
    risk: DataFrame,
    scorer: Scorer,
    model_version: int,
    date: str = "auto",
    scored_at: Column | None = None,
    settings: Settings = DEFAULTS,
    states: DayStates | None = None,
) -> DataFrame:
    """Predictions for one day; fails if the day has no transactions.

    With ``states`` of the days before, only the rows of two days are read.
    """
    day = resolve_date(txns, date)
    if states is None:
        rows = scoring_features(txns, risk, day, settings)
    else:
        rows = day_features(txns, states, risk, day, settings)
    scored = written(
        scorer(rows).select(
            "transaction_id", "event_ts", "customer_id", "amount", "fraud_score"
        ),
        "scored",
    )
    if scored.isEmpty():
        raise ValueError(f"no transactions found for {day}")
    return as_predictions(flag_alerts(scored, settings), model_version, scored_at)


def as_predictions(flagged: DataFrame, model_version: int, scored_at: Column | None = None) -> DataFrame:
    return flagged.select(
        "transaction_id",
        "event_ts",
        "customer_id",
        "amount",
        "fraud_score",
        "is_alert",
        F.lit(model_version).cast("int").alias("model_version"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
    )
