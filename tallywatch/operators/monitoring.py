"""Score drift and alert effectiveness per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.functions.expressions import bin_edges, bin_index, ratio

MONITORING_DDL = (
    "monitor_date STRING, model_version INT, psi DOUBLE, scored_count INT, alert_count INT, "
    "actual_fraud_count INT, true_positive_count INT, alert_precision DOUBLE, "
    "fraud_recall DOUBLE, computed_at TIMESTAMP"
)
BASELINE_DDL = "bin_low DOUBLE, bin_high DOUBLE, fraction DOUBLE, model_version INT"


def score_histogram(
    scored: DataFrame,
    by: list[Column] | None = None,
    settings: Settings = DEFAULTS,
    also: list[Column] | None = None,
) -> DataFrame:
    """Rows and share per score bin, empty bins included, per group of ``by``.

    The bins are counted side by side in one aggregate and unfolded after it;
    the aggregates of ``also`` are taken in the same pass and repeated per bin.
    """
    bins = settings.score_bins
    edges = bin_edges(bins)
    position = bin_index(F.col("fraud_score"), bins)
    groups = by or []
    counts = scored.groupBy(*groups).agg(
        F.count(position).alias("_total"),
        *[F.count_if(position == i).alias(f"_bin{i}") for i in range(bins)],
        *(also or []),
    )
    unfolded = F.array(
        *[
            F.struct(
                F.lit(i).alias("bin"),
                F.lit(edges[i]).alias("bin_low"),
                F.lit(edges[i + 1]).alias("bin_high"),
                F.col(f"_bin{i}").alias("n"),
                (F.col(f"_bin{i}") / F.greatest("_total", F.lit(1))).alias("fraction"),
            )
            for i in range(bins)
        ]
    )
    kept = [c for c in counts.columns if not c.startswith("_")]
    return counts.select(*kept, F.inline(unfolded))


def score_baseline(scored: DataFrame, model_version: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Distribution of a promoted model's scores, to compare later days with."""
    return score_histogram(scored, settings=settings).select(
        "bin_low", "bin_high", "fraction", F.lit(model_version).cast("int").alias("model_version")
    )


def psi_term(actual: Column, expected: Column, settings: Settings = DEFAULTS) -> Column:
    floor = F.lit(settings.psi_floor)
    a, e = F.greatest(actual, floor), F.greatest(expected, floor)
    return (a - e) * F.log(a / e)


def psi_band(psi: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(psi < settings.psi_watch_level, "STABLE")
        .when(psi < settings.psi_alert_level, "WATCH")
        .otherwise("DRIFT")
    )


def drift(preds: DataFrame, baseline: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Population stability index of every prediction date against the baseline."""
    return _drift_of(score_histogram(preds, [_monitor_date()], settings), baseline, settings)


def _drift_of(
    days: DataFrame, baseline: DataFrame, settings: Settings, kept: tuple[str, ...] = ()
) -> DataFrame:
    """Index per date from unfolded bins; ``kept`` columns are the same in all bins of a date."""
    expected = baseline.select(
        F.round(F.col("bin_low") * settings.score_bins).cast("int").alias("bin"),
        F.col("fraction").alias("expected"),
    )
    # one row per bin
    joined = days.join(F.broadcast(expected), "bin")
    psi = F.sum(psi_term(F.col("fraction"), F.col("expected"), settings))
    return joined.groupBy("monitor_date").agg(psi.alias("psi"), *[F.max(c).alias(c) for c in kept])


def effectiveness(preds: DataFrame, labels: DataFrame) -> DataFrame:
    """Alert counts and quality per date, over predictions that have a label."""
    hit = (F.col("is_alert") == 1) & (F.col("is_fraud") == 1)
    counts = (
        preds.select("transaction_id", "event_ts", "is_alert")
        .join(labels.select("transaction_id", "is_fraud"), "transaction_id")
        .groupBy(_monitor_date())
        .agg(
            F.count("*").cast("int").alias("scored_count"),
            F.coalesce(F.sum("is_alert"), F.lit(0)).cast("int").alias("alert_count"),
            F.coalesce(F.sum("is_fraud"), F.lit(0)).cast("int").alias("actual_fraud_count"),
            F.count_if(hit).cast("int").alias("true_positive_count"),
        )
    )
    found = F.col("true_positive_count")
    return counts.withColumns(
        {
            "alert_precision": ratio(found, F.col("alert_count")),
            "fraud_recall": ratio(found, F.col("actual_fraud_count")),
        }
    )


def monitoring_rows(
    preds: DataFrame,
    labels: DataFrame,
    baseline: DataFrame,
    computed_at: Column | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row of metrics per prediction date, with the newest model version of the date.

    Versions, bins and counts come from one pass over the predictions. A repeated
    label counts once, as fraud if any copy says so. A date without labelled
    predictions has counts of 0 and neither precision nor recall.
    """
    known = labels.groupBy("transaction_id").agg(F.max("is_fraud").alias("is_fraud"))
    joined = preds.select("transaction_id", "event_ts", "fraud_score", "is_alert", "model_version").join(
        known.withColumn("labelled", F.lit(True)), "transaction_id", "left"
    )
    alerted, fraud = F.col("labelled") & (F.col("is_alert") == 1), F.col("is_fraud") == 1
    counts = {
        "scored_count": F.count("labelled"),
        "alert_count": F.count_if(alerted),
        "actual_fraud_count": F.count_if(fraud),
        "true_positive_count": F.count_if(alerted & fraud),
    }
    also = [F.max("model_version").alias("model_version"), *[n.alias(c) for c, n in counts.items()]]
    days = score_histogram(joined, [_monitor_date()], settings, also)
    found, some = F.col("true_positive_count"), F.col("scored_count") > 0
    return _drift_of(days, baseline, settings, ("model_version", *counts)).select(
        "monitor_date",
        "model_version",
        "psi",
        *[F.col(c).cast("int").alias(c) for c in counts],
        F.when(some, ratio(found, F.col("alert_count"))).alias("alert_precision"),
        F.when(some, ratio(found, F.col("actual_fraud_count"))).alias("fraud_recall"),
        (F.current_timestamp() if computed_at is None else computed_at).alias("computed_at"),
    )


def _monitor_date() -> Column:
    return F.to_date("event_ts").cast("string").alias("monitor_date")
