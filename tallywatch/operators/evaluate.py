"""Exact ranking metrics, candidate choice and the promotion gate.

Inputs are long: one row per (model, transaction) with ``model``,
``transaction_id``, ``is_fraud`` and ``fraud_score``, so several models are
evaluated in one pass over the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.functions.expressions import ratio
from tallywatch.operators.prefix import sums_before
from tallywatch.session import written


def class_weights(rows: DataFrame) -> DataFrame:
    """Weight (1 - p) / p for positives, 1 for the rest; p is the positive rate."""
    rate = rows.select(F.avg("is_fraud").alias("p"))
    weight = rate.select(ratio(1 - F.col("p"), F.col("p"))).scalar()
    return rows.withColumn("weight", F.when(F.col("is_fraud") == 1, weight).otherwise(1.0))


def _score_buckets(counts: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """Add ``bucket``, which rises as a model's scores fall, and give the number of buckets.

    A bucket holds about ``bucket_rows`` scores; beyond the square of that many scores it
    holds more, so that there are never more buckets than scores in one. The rows are
    dealt by range and stored, so every reader sees the same buckets.
    """
    rows = counts.count()
    buckets = 1 + min(rows // settings.bucket_rows, math.isqrt(rows))
    dealt = counts.repartitionByRange(buckets, "model", F.desc("fraud_score"))
    return written(dealt.withColumn("bucket", F.spark_partition_id()), "score-buckets"), buckets


def threshold_curve(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """True and false positives at every distinct score, per model.

    A running total over all scores would need one task. Scores are counted,
    dealt by range to as many buckets as their number asks for, and summed inside
    each bucket; the totals of the buckets above come from a tree of partial totals.
    """
    counts = written(
        scored.where(F.col("fraud_score").isNotNull())
        .groupBy("model", "fraud_score")
        .agg(
            F.count_if(F.col("is_fraud") == 1).alias("pos"),
            F.count_if(F.col("is_fraud") == 0).alias("neg"),
        ),
        "score-counts",
    )
    counts, buckets = _score_buckets(counts, settings)
    totals = counts.groupBy("model", "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    whole = totals.groupBy("model").agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    offsets = sums_before(totals, ["model"], "bucket", ["pos", "neg"], buckets, settings.prefix_fanout).drop("pos", "neg")
    inside = (
        Window.partitionBy("model", "bucket")
        .orderBy(F.desc("fraud_score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = counts.select("*", F.sum("pos").over(inside).alias("pos_inside"), F.sum("neg").over(inside).alias("neg_inside"))
    # the window has dealt the rows by the columns of the first join; the second side has one row
    # for each model that the caller compares
    return summed.join(offsets, ["model", "bucket"]).join(F.broadcast(whole), "model").select(
        "model",
        "fraud_score",
        "pos",
        "neg",
        (F.col("pos_above") + F.col("pos_inside")).alias("tp"),
        (F.col("neg_above") + F.col("neg_inside")).alias("fp"),
        "positives",
        "negatives",
    )


def average_precision() -> Column:
    """Sum of recall steps times precision; over a threshold curve."""
    step = ratio(F.col("pos"), F.col("positives"))
    return F.sum(step * ratio(F.col("tp"), F.col("tp") + F.col("fp")))


def roc_area() -> Column:
    """Share of (positive, negative) pairs ranked right, ties counted half."""
    pairs = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return ratio(F.sum(pairs), F.max(F.col("positives").cast("double") * F.col("negatives")))


def recall_at_fpr(max_fpr: float) -> Column:
    """Best recall among thresholds whose false positive rate is within the limit."""
    within = ratio(F.col("fp"), F.col("negatives")) <= max_fpr
    return F.coalesce(F.max(F.when(within, ratio(F.col("tp"), F.col("positives")))), F.lit(0.0))


def curve_metrics(curve: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return curve.groupBy("model").agg(
        average_precision().alias("pr_auc"),
        roc_area().alias("roc_auc"),
        recall_at_fpr(settings.max_fpr).alias("recall_at_fpr"),
    )


def precision_at_k(
    scored: DataFrame, settings: Settings = DEFAULTS, per: tuple[str, ...] = ()
) -> DataFrame:
    """Precision among the k best scores per model, or per model and ``per`` columns.

    The rank filter keeps k rows per map task before the shuffle.
    """
    groups = ["model", *per]
    best = Window.partitionBy(*groups).orderBy(F.desc("fraud_score"), "transaction_id")
    top = scored.withColumn("_rank", F.row_number().over(best)).where(
        F.col("_rank") <= settings.max_daily_alerts
    )
    return top.groupBy(*groups).agg(F.avg("is_fraud").alias("precision_at_k"))


def evaluate(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """All metrics, one row per model."""
    curve = threshold_curve(scored, settings)
    return curve_metrics(curve, settings).join(precision_at_k(scored, settings), "model")


def best_candidate(metrics: DataFrame, candidates: list[str]) -> DataFrame:
    """The candidate with the highest PR-AUC; the first name wins a tie."""
    return (
        metrics.where(F.col("model").isin(candidates))
        .orderBy(F.desc("pr_auc"), "model")
        .limit(1)
    )


def promotion_gate(
    metrics: DataFrame,
    candidates: list[str],
    incumbent: str | None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row: the challenger, both PR-AUCs on the same rows, and the decision."""
    current = metrics.where(F.col("model") == F.lit(incumbent)).select(F.max("pr_auc")).scalar()
    chosen = best_candidate(metrics, candidates).select(
        F.col("model").alias("challenger"),
        F.col("pr_auc").alias("challenger_pr_auc"),
        current.alias("incumbent_pr_auc"),
    )
    wins = F.col("challenger_pr_auc") >= F.col("incumbent_pr_auc") + settings.min_promotion_gain
    return chosen.withColumn(
        "promoted", (F.col("incumbent_pr_auc").isNull() | wins).cast("int")
    )
