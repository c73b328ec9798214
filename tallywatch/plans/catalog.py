"""Every registered query: an operator run over the provided tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS
from tallywatch.functions.expressions import stable_round
from tallywatch.operators import contract, daystate, dedup, evaluate, features, gold, monitoring, observed, scoring, training
from tallywatch.operators.upsert import upsert, upsert_into
from tallywatch.plans import dashboard
from tallywatch.plans.lifecycle import WHOLE_HISTORY
from tallywatch.session import new_folder, shared_folder, written
from tallywatch.sources import fixtures
from tallywatch.sources.admission import feed_days
from tallywatch.sources.feed import read_bronze, read_feed, read_lines
from tallywatch.sources.running import RunningTable
from tallywatch.sources.tables import VersionedTable
from tallywatch.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

SCORED_AT = "2024-02-02 00:00:00"
BACKFILL_DATE = "2024-01-15"
INGEST_DATE = dt.date(2024, 2, 1)
SPLIT_FEED = dt.date(2024, 1, 28)
LATE_FEED = dt.date(2024, 1, 15)
FIRST_LOAD_END = dt.date(2024, 1, 27)
RESCORE_START = dt.date(2024, 1, 26)
SMALL_BUDGET = replace(DEFAULTS, max_daily_alerts=40)
CARDS = {"card_a": 7919, "card_b": 3967, "incumbent": 6007}
TYPED = list(contract.CONTRACT)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.silver(fixtures.bronze(spark, sf_dir))


def _silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table in storage, for queries that read it more than once."""
    return written(_silver(spark, sf_dir), "silver")


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.quarantine(contract.typed(fixtures.bronze(spark, sf_dir)))


def _scored_at() -> Column:
    return F.to_timestamp(F.lit(SCORED_AT))


# ---- contract and ingestion ------------------------------------------------


def _feed(spark: SparkSession, sf_dir: str) -> ingest.Layers:
    layers = ingest.Layers(new_folder(spark, "layers"))
    fixtures.write_feed(fixtures.feed_lines(spark, sf_dir), layers.feed)
    return layers


def bronze_ingest(spark, sf_dir):
    layers = _feed(spark, sf_dir)
    ingest.run_bronze(spark, layers)
    return contract.typed(read_bronze(spark, layers.bronze)).select(*TYPED)


def bronze_batch(spark, sf_dir):
    return contract.typed(read_feed(spark, _feed(spark, sf_dir).feed)).select(*TYPED)


def bronze_lineage(spark, sf_dir):
    """Rows per feed date, as the path of the file says that each row keeps, and rows with a time of ingestion in the past."""
    layers = _feed(spark, sf_dir)
    ingest.run_bronze(spark, layers)
    date = F.regexp_extract("_source_file", "/feed_date=([^/]+)/", 1).cast("date")
    return read_bronze(spark, layers.bronze).groupBy(date.alias("feed_date")).agg(
        F.count("*").alias("landed_rows"),
        F.count_if(F.col("_ingested_at") <= F.current_timestamp()).alias("stamped_rows"),
    )


def bronze_rescued(spark, sf_dir):
    rows = contract.typed(read_feed(spark, _feed(spark, sf_dir).feed))
    return rows.where("_rescued_data IS NOT NULL").select("transaction_id", "amount", "_rescued_data")


def feed_types(spark, sf_dir):
    return observed.observed_types(read_lines(spark, _feed(spark, sf_dir).feed))


def _streamed(spark: SparkSession, sf_dir: str) -> ingest.Layers:
    """Two incremental runs: most days first, the last days after them."""
    layers = ingest.Layers(new_folder(spark, "layers"))
    shared_folder(spark)
    lines = written(fixtures.feed_lines(spark, sf_dir), "lines")
    fixtures.write_feed(lines.where(F.col("feed_date") <= F.lit(SPLIT_FEED)), layers.feed)
    ingest.run_update(spark, layers)
    fixtures.write_feed(lines.where(F.col("feed_date") > F.lit(SPLIT_FEED)), layers.feed)
    ingest.run_update(spark, layers)
    return layers


def stream_silver(spark, sf_dir):
    return ingest.read_silver(spark, _streamed(spark, sf_dir)).select(*TYPED)


def stream_quarantine(spark, sf_dir):
    return ingest.read_quarantine(spark, _streamed(spark, sf_dir)).select(*TYPED, "_quarantine_reason")


def stream_late(spark, sf_dir):
    """A whole day delivered far behind the watermark: every row is in Silver or in quarantine."""
    layers = ingest.Layers(new_folder(spark, "layers"))
    lines = written(fixtures.feed_lines(spark, sf_dir), "lines")
    in_time = (F.col("feed_date") <= F.lit(SPLIT_FEED)) & (F.col("feed_date") != F.lit(LATE_FEED))
    for rows in (lines.where(in_time), lines.where(~in_time)):
        fixtures.write_feed(rows, layers.feed)
        ingest.run_update(spark, layers)
    clean = ingest.read_silver(spark, layers).withColumn("_quarantine_reason", F.lit(None).cast("string"))
    columns = [*TYPED, "_quarantine_reason"]
    return clean.select(*columns).unionByName(ingest.read_quarantine(spark, layers).select(*columns))


def _kept(spark, layers):
    """Clean, rejected and late rows together."""
    clean = ingest.read_silver(spark, layers).withColumn("_quarantine_reason", F.lit(None).cast("string"))
    columns = [*TYPED, "_quarantine_reason"]
    return clean.select(*columns).unionByName(ingest.read_quarantine(spark, layers).select(*columns))


def _late_loads(spark, sf_dir):
    """Lines of two deliveries; the second holds a whole day far behind the watermark."""
    lines = written(fixtures.feed_lines(spark, sf_dir), "lines")
    in_time = (F.col("feed_date") <= F.lit(SPLIT_FEED)) & (F.col("feed_date") != F.lit(LATE_FEED))
    return lines.where(in_time), lines.where(~in_time)


def stream_restart(spark, sf_dir):
    """The late delivery again, with a driver that stops after the clean rows are stored; the next run has no new file."""
    layers = ingest.Layers(new_folder(spark, "layers"))
    first, second = _late_loads(spark, sf_dir)
    fixtures.write_feed(first, layers.feed)
    ingest.run_update(spark, layers)
    fixtures.write_feed(second, layers.feed)
    ingest.run_bronze(spark, layers)
    ingest.run_silver(spark, layers)
    ingest.run_update(spark, layers)
    return _kept(spark, layers)


def stream_repeated_id(spark, sf_dir):
    """Rows of an early day sent again as events of the last one, when the stream has forgotten their ids."""
    layers = _streamed(spark, sf_dir)
    lines = written(fixtures.feed_lines(spark, sf_dir), "lines")
    days = lines.agg(F.min("feed_date").alias("first"), F.max("feed_date").alias("last")).first()
    again = lines.where(F.col("feed_date") == F.lit(days["first"]))
    moved = F.regexp_replace("value", str(days["first"]), str(days["last"]))
    fixtures.write_feed(again.withColumns({"value": moved, "feed_date": F.lit(days["last"])}), layers.feed)
    ingest.run_update(spark, layers)
    return ingest.read_silver(spark, layers).select(*TYPED)


def stream_expectations(spark, sf_dir):
    """Rows checked and passed per rule, summed over the batches of two runs."""
    counts = ingest.read_rule_counts(spark, _streamed(spark, sf_dir))
    return counts.groupBy("rule").agg(F.sum("checked").alias("checked"), F.sum("passed").alias("passed"))


def backfill_late_day(spark, sf_dir):
    """The day that came behind the watermark, moved from quarantine to the clean rows."""
    layers = ingest.Layers(new_folder(spark, "layers"))
    for rows in _late_loads(spark, sf_dir):
        fixtures.write_feed(rows, layers.feed)
        ingest.run_update(spark, layers)
    ingest.merge_late(spark, layers, [LATE_FEED])
    return _kept(spark, layers)


def stream_backlog(spark, sf_dir):
    """The whole feed waiting at the first run, taken by date in groups of about a quarter of its bytes."""
    layers = _feed(spark, sf_dir)
    size = feed_days(spark, layers.feed).agg(F.sum("bytes")).first()[0]
    ingest.run_update(spark, layers, replace(DEFAULTS, admitted_bytes=size // 4))
    return _kept(spark, layers)


def silver_transactions(spark, sf_dir):
    return _silver(spark, sf_dir).select(*TYPED)


def silver_dedup_first(spark, sf_dir):
    return dedup.silver(fixtures.bronze(spark, sf_dir), validate_first=False).select(*TYPED)


def silver_dedup(spark, sf_dir):
    return fixtures.order_transactions(spark, sf_dir)


def silver_quarantine(spark, sf_dir):
    return _rejected(spark, sf_dir).select(*TYPED, "_quarantine_reason")


def expectation_metrics(spark, sf_dir):
    return contract.expectation_metrics(contract.typed(fixtures.bronze(spark, sf_dir)))


# ---- aggregates ------------------------------------------------------------


def gold_daily_kpis(spark, sf_dir):
    return gold.daily_kpis(_silver(spark, sf_dir))


def gold_merchant_stats(spark, sf_dir):
    return gold.merchant_stats(_silver(spark, sf_dir))


def gold_customer_profiles(spark, sf_dir):
    return gold.customer_profiles(_silver(spark, sf_dir))


def gold_daily_kpis_orders(spark, sf_dir):
    return gold.daily_kpis(fixtures.order_transactions(spark, sf_dir))


def gold_merchant_stats_orders(spark, sf_dir):
    return gold.merchant_stats(fixtures.order_transactions(spark, sf_dir))


def gold_customer_profiles_orders(spark, sf_dir):
    return gold.customer_profiles(fixtures.order_transactions(spark, sf_dir))


def _running(spark: SparkSession, txns: DataFrame, name: str) -> DataFrame:
    """An aggregate taken in three updates; customers and merchants recur in all of them."""
    table = RunningTable(spark, new_folder(spark, "running"), WHOLE_HISTORY[name])
    part = F.pmod(F.dayofmonth("event_ts"), F.lit(3)).cast("string")
    for nth in range(1, 4):
        table.update([str(p) for p in range(nth)], lambda new: txns.where(part.isin(new)))
    return table.read()


def gold_running_merchants(spark, sf_dir):
    return _running(spark, _silver_table(spark, sf_dir), "gold_merchant_stats")


def gold_running_profiles(spark, sf_dir):
    return _running(spark, _silver_table(spark, sf_dir), "gold_customer_profiles")


def gold_running_profiles_orders(spark, sf_dir):
    txns = fixtures.order_transactions(spark, sf_dir).select(*gold.FOOTPRINT, "amount", "event_ts")
    return _running(spark, written(txns, "order-transactions"), "gold_customer_profiles")


# ---- features --------------------------------------------------------------


def _train_rows(txns: DataFrame) -> DataFrame:
    return features.time_split(txns, features.split_bounds(txns)).where("split = 'train'").drop("split")


def _shown(rows: DataFrame) -> DataFrame:
    fractions = ("log_amount", "amount_over_avg", "merchant_fraud_rate")
    return rows.select(
        "transaction_id",
        *[
            stable_round(F.col(c), 6).alias(c) if c in fractions else F.col(c)
            for c in features.FEATURE_COLS
        ],
    )


def _risk_table(train: DataFrame) -> DataFrame:
    """The risk snapshot in storage, as scoring would read it."""
    return written(features.merchant_risk(train), "risk")


def merchant_risk(spark, sf_dir):
    risk = features.merchant_risk(_train_rows(_silver_table(spark, sf_dir)))
    return risk.withColumn("merchant_fraud_rate", stable_round(F.col("merchant_fraud_rate"), 8))


def time_split(spark, sf_dir):
    txns = _silver_table(spark, sf_dir)
    rows = features.time_split(txns, features.split_bounds(txns))
    return rows.select("transaction_id", "event_ts", "split")


def feature_rows(spark, sf_dir):
    txns = _silver_table(spark, sf_dir)
    return _shown(features.build_features(txns, _risk_table(_train_rows(txns))))


def feature_rows_orders(spark, sf_dir):
    txns = written(fixtures.order_transactions(spark, sf_dir), "order-transactions")
    return _shown(features.build_features(txns, _risk_table(txns)))


def class_weights(spark, sf_dir):
    rows = evaluate.class_weights(_silver_table(spark, sf_dir))
    return rows.select("transaction_id", "is_fraud", stable_round(F.col("weight"), 6).alias("weight"))


# ---- evaluation ------------------------------------------------------------


def _carded(txns: DataFrame, cards: dict[str, int]) -> DataFrame:
    """Long scored rows, one per (card, transaction), from one read of ``txns``."""
    scores = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                fixtures.scorecard(F.col("transaction_id"), factor).alias("fraud_score"),
            )
            for name, factor in cards.items()
        ]
    )
    return txns.select("transaction_id", "event_ts", "is_fraud", F.inline(scores))


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_curve(_carded(_silver(spark, sf_dir), CARDS))


def threshold_curve(spark, sf_dir):
    return _curve(spark, sf_dir)


def eval_pr_auc(spark, sf_dir):
    value = stable_round(evaluate.average_precision(), 6).alias("pr_auc")
    return _curve(spark, sf_dir).groupBy("model").agg(value)


def eval_roc_auc(spark, sf_dir):
    value = stable_round(evaluate.roc_area(), 6).alias("roc_auc")
    return _curve(spark, sf_dir).groupBy("model").agg(value)


def eval_recall_at_fpr(spark, sf_dir):
    value = stable_round(evaluate.recall_at_fpr(DEFAULTS.max_fpr), 6).alias("recall_at_fpr")
    return _curve(spark, sf_dir).groupBy("model").agg(value)


def eval_precision_at_k(spark, sf_dir):
    best = evaluate.precision_at_k(_carded(_silver(spark, sf_dir), CARDS))
    return best.withColumn("precision_at_k", stable_round(F.col("precision_at_k"), 6))


def eval_precision_at_k_daily(spark, sf_dir):
    rows = _carded(_silver(spark, sf_dir), CARDS).withColumn("score_date", F.to_date("event_ts"))
    best = evaluate.precision_at_k(rows, SMALL_BUDGET, per=("score_date",))
    return best.withColumn("precision_at_k", stable_round(F.col("precision_at_k"), 6))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate(written(_carded(_silver(spark, sf_dir), CARDS), "scored"))


def promotion_gate(spark, sf_dir):
    metrics = written(_metrics(spark, sf_dir), "metrics")
    gate = evaluate.promotion_gate(metrics, ["card_a", "card_b"], "incumbent")
    rounded = ("challenger_pr_auc", "incumbent_pr_auc")
    return gate.withColumns({c: stable_round(F.col(c), 6) for c in rounded})


# ---- scoring ---------------------------------------------------------------


def _card(multiplier: int) -> scoring.Scorer:
    def scorer(rows: DataFrame) -> DataFrame:
        return rows.withColumn("fraud_score", fixtures.scorecard(F.col("transaction_id"), multiplier))

    return scorer


def _predictions(txns: DataFrame, multiplier: int, version: int, settings=DEFAULTS) -> DataFrame:
    """Every day of ``txns`` scored with a card."""
    scored = written(
        _card(multiplier)(txns).select(
            "transaction_id", "event_ts", "customer_id", "amount", "fraud_score"
        ),
        "scored",
    )
    return scoring.as_predictions(scoring.flag_alerts(scored, settings), version, _scored_at())


def _batch(spark: SparkSession, sf_dir: str, scorer: scoring.Scorer, date: str) -> DataFrame:
    txns = _silver_table(spark, sf_dir)
    risk = _risk_table(_train_rows(txns))
    return scoring.batch_score(txns, risk, scorer, 1, date, _scored_at())


def batch_score_alerts(spark, sf_dir):
    return _batch(spark, sf_dir, _card(CARDS["card_a"]), "auto")


def batch_score_points(spark, sf_dir):
    return _batch(spark, sf_dir, fixtures.points, "auto")


def batch_score_backfill(spark, sf_dir):
    return _batch(spark, sf_dir, fixtures.points, BACKFILL_DATE)


def _day_batch(spark: SparkSession, sf_dir: str, date: str) -> DataFrame:
    txns = _silver_table(spark, sf_dir)
    states = daystate.DayStates(written(daystate.customer_days(txns), "customer-days"), written(daystate.device_days(txns), "device-days"))
    risk = _risk_table(_train_rows(txns))
    return scoring.batch_score(txns, risk, fixtures.points, 1, date, _scored_at(), states=states)


def batch_score_daystate(spark, sf_dir):
    return _day_batch(spark, sf_dir, "auto")


def batch_score_daystate_backfill(spark, sf_dir):
    return _day_batch(spark, sf_dir, BACKFILL_DATE)


def batch_score_budget(spark, sf_dir):
    return _predictions(_silver(spark, sf_dir), CARDS["card_a"], 1, SMALL_BUDGET)


def _stored_predictions(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """A first load, then newer days and a re-score of older ones with another version."""
    ddl = f"{scoring.PREDICTIONS_DDL}, event_date DATE"
    table = VersionedTable(spark, new_folder(spark, "predictions"), ddl, "event_date")
    txns = _silver_table(spark, sf_dir)
    day = F.to_date("event_ts")
    loads = [
        (CARDS["card_a"], 1, txns.where(day <= F.lit(FIRST_LOAD_END))),
        (CARDS["incumbent"], 2, txns.where(day >= F.lit(RESCORE_START))),
    ]
    for multiplier, version, rows in loads:
        batch = _predictions(rows, multiplier, version).withColumn("event_date", day)
        upsert_into(table, written(batch, "batch"), ["transaction_id"])
    return table


def upsert_predictions(spark, sf_dir):
    return _stored_predictions(spark, sf_dir).read().drop("event_date")


# ---- monitoring ------------------------------------------------------------


def _baseline(txns: DataFrame) -> DataFrame:
    """Score distribution of card A on the test window."""
    rows = features.time_split(txns, features.split_bounds(txns)).where("split = 'test'")
    return monitoring.score_baseline(_card(CARDS["card_a"])(rows), 1)


def score_baseline_hist(spark, sf_dir):
    rows = _baseline(_silver_table(spark, sf_dir))
    return rows.withColumns({c: stable_round(F.col(c), 8) for c in ("bin_low", "bin_high", "fraction")})


def _monitored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    txns = _silver_table(spark, sf_dir)
    return written(_predictions(txns, CARDS["card_a"], 1), "predictions"), txns, _baseline(txns)


def monitoring_psi(spark, sf_dir):
    preds, _, baseline = _monitored(spark, sf_dir)
    rows = monitoring.drift(preds, baseline).withColumn("psi", stable_round(F.col("psi"), 6))
    return rows.withColumn("band", monitoring.psi_band(F.col("psi")))


def monitoring_effectiveness(spark, sf_dir):
    preds, txns, _ = _monitored(spark, sf_dir)
    return _rounded_quality(monitoring.effectiveness(preds, txns))


def _rounded_quality(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: stable_round(F.col(c), 6) for c in ("psi", "alert_precision", "fraud_recall") if c in rows.columns}
    )


def _monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.monitoring_rows(*_monitored(spark, sf_dir), computed_at=_scored_at())


def monitoring_metrics(spark, sf_dir):
    return _rounded_quality(_monitoring(spark, sf_dir))


def upsert_monitoring(spark, sf_dir):
    """Metrics of version 1 for all days, then of version 2 for the last days, stored twice."""
    table = VersionedTable(
        spark, new_folder(spark, "monitoring"), monitoring.MONITORING_DDL, "monitor_date"
    )
    txns = _silver_table(spark, sf_dir)
    baseline = written(_baseline(txns), "baseline")
    recent = txns.where(F.to_date("event_ts") >= F.lit(RESCORE_START))
    for multiplier, version, rows in [(CARDS["card_a"], 1, txns), (CARDS["incumbent"], 2, recent)]:
        preds = written(_predictions(rows, multiplier, version), "predictions")
        batch = written(
            monitoring.monitoring_rows(preds, txns, baseline, _scored_at()), "metrics"
        )
        upsert_into(table, batch, ["monitor_date", "model_version"])
    upsert_into(table, batch, ["monitor_date", "model_version"])
    return _rounded_quality(table.read())


def upsert_rows(spark, sf_dir):
    """The operator itself on frames: later order lines replace earlier ones."""
    rows = written(fixtures.order_transactions(spark, sf_dir), "order-transactions")
    columns = ["transaction_id", "event_ts", "amount"]
    batch = rows.where("is_fraud = 1").select(*columns).withColumn("amount", -F.col("amount"))
    target = rows.where("channel = 'online'").select(*columns)
    return upsert(target, batch, ["transaction_id"])


# ---- reports ---------------------------------------------------------------


def dash_01(spark, sf_dir):
    return dashboard.daily_volumes(gold_daily_kpis(spark, sf_dir))


def dash_02(spark, sf_dir):
    return dashboard.headline(gold_daily_kpis(spark, sf_dir))


def dash_03(spark, sf_dir):
    txns = _silver_table(spark, sf_dir)
    return dashboard.review_queue(written(_predictions(txns, CARDS["card_a"], 1), "predictions"), txns)


def dash_04(spark, sf_dir):
    return dashboard.incidence_by_category(gold_merchant_stats(spark, sf_dir))


def dash_05(spark, sf_dir):
    return dashboard.riskiest_merchants(gold_merchant_stats(spark, sf_dir))


def dash_06(spark, sf_dir):
    return dashboard.pattern_mix(_silver(spark, sf_dir))


def dash_07(spark, sf_dir):
    return dashboard.hourly_heatmap(_silver(spark, sf_dir))


def dash_08(spark, sf_dir):
    return dashboard.quarantine_trend(_rejected(spark, sf_dir))


def dash_09(spark, sf_dir):
    bronze = fixtures.bronze(spark, sf_dir)
    return dashboard.reconciliation(bronze, dedup.silver(bronze), contract.quarantine(contract.typed(bronze)))


def dash_10(spark, sf_dir):
    rows = dashboard.health_trend(_monitoring(spark, sf_dir))
    return rows.withColumn("psi", stable_round(F.col("psi"), 6))


def dash_11(spark, sf_dir):
    txns = _silver(spark, sf_dir)
    return dashboard.score_distribution(written(_predictions(txns, CARDS["card_a"], 1), "predictions"))


def dash_12(spark, sf_dir):
    txns = _silver_table(spark, sf_dir)
    return dashboard.missed_fraud(txns, _predictions(txns, CARDS["card_a"], 1))


def runbook_quarantine_day(spark, sf_dir):
    return dashboard.quarantine_on(_rejected(spark, sf_dir), INGEST_DATE)


def star_fraud_by_month(spark, sf_dir):
    return dashboard.fraud_amount_by_month(*dashboard.star_schema(_silver_table(spark, sf_dir)))


# ---- models ----------------------------------------------------------------


def _trained(spark: SparkSession, sf_dir: str, fit, name: str) -> DataFrame:
    """Metrics on the test window of a model fitted on the training window."""
    txns = _silver_table(spark, sf_dir)
    risk = _risk_table(_train_rows(txns))
    rows = features.time_split(
        features.build_features(txns, risk), features.split_bounds(txns)
    )
    rows = written(rows, "features")
    model = fit(rows.where("split = 'train'"))
    scored = training.score_with(model)(rows.where("split = 'test'")).select(
        F.lit(name).alias("model"), "transaction_id", "is_fraud", "fraud_score"
    )
    return evaluate.evaluate(written(scored, "test-scores"))


def train_score_logreg(spark, sf_dir):
    return _trained(spark, sf_dir, training.fit_logistic, training.LOGISTIC)


def train_score_gbt(spark, sf_dir):
    return _trained(spark, sf_dir, training.fit_boosted, training.BOOSTED)


#: Gradients at the start are between 0.01 and 1; at the optimum they are far below this.
NO_GRADIENT = 1e-5


def train_logreg_optimum(spark, sf_dir):
    """Whether the loss has no gradient left at the fitted coefficients, per term."""
    txns = _silver_table(spark, sf_dir)
    rows = features.time_split(features.build_features(txns, _risk_table(_train_rows(txns))), features.split_bounds(txns))
    train = written(rows.where("split = 'train'"), "features")
    terms = training.logistic_gradient(training.fit_logistic(train), train)
    return terms.select("term", (F.abs("gradient") < NO_GRADIENT).alias("optimal"), "train_rows", "positives")


QUERIES: dict[str, Query] = {
    "bronze_ingest": bronze_ingest,
    "bronze_batch": bronze_batch,
    "bronze_lineage": bronze_lineage,
    "bronze_rescued": bronze_rescued,
    "feed_types": feed_types,
    "stream_silver": stream_silver,
    "stream_quarantine": stream_quarantine,
    "stream_late": stream_late,
    "stream_restart": stream_restart,
    "stream_repeated_id": stream_repeated_id,
    "stream_expectations": stream_expectations,
    "backfill_late_day": backfill_late_day,
    "stream_backlog": stream_backlog,
    "silver_transactions": silver_transactions,
    "silver_dedup_first": silver_dedup_first,
    "silver_dedup": silver_dedup,
    "silver_quarantine": silver_quarantine,
    "expectation_metrics": expectation_metrics,
    "gold_daily_kpis": gold_daily_kpis,
    "gold_merchant_stats": gold_merchant_stats,
    "gold_customer_profiles": gold_customer_profiles,
    "gold_daily_kpis_orders": gold_daily_kpis_orders,
    "gold_merchant_stats_orders": gold_merchant_stats_orders,
    "gold_customer_profiles_orders": gold_customer_profiles_orders,
    "gold_running_merchants": gold_running_merchants,
    "gold_running_profiles": gold_running_profiles,
    "gold_running_profiles_orders": gold_running_profiles_orders,
    "merchant_risk": merchant_risk,
    "time_split": time_split,
    "features": feature_rows,
    "features_orders": feature_rows_orders,
    "class_weights": class_weights,
    "threshold_curve": threshold_curve,
    "eval_pr_auc": eval_pr_auc,
    "eval_roc_auc": eval_roc_auc,
    "eval_recall_at_fpr": eval_recall_at_fpr,
    "eval_precision_at_k": eval_precision_at_k,
    "eval_precision_at_k_daily": eval_precision_at_k_daily,
    "promotion_gate": promotion_gate,
    "batch_score_alerts": batch_score_alerts,
    "batch_score_points": batch_score_points,
    "batch_score_backfill": batch_score_backfill,
    "batch_score_daystate": batch_score_daystate,
    "batch_score_daystate_backfill": batch_score_daystate_backfill,
    "batch_score_budget": batch_score_budget,
    "upsert_predictions": upsert_predictions,
    "upsert_rows": upsert_rows,
    "score_baseline_hist": score_baseline_hist,
    "monitoring_psi": monitoring_psi,
    "monitoring_effectiveness": monitoring_effectiveness,
    "monitoring_metrics": monitoring_metrics,
    "upsert_monitoring": upsert_monitoring,
    "dash_01": dash_01,
    "dash_02": dash_02,
    "dash_03": dash_03,
    "dash_04": dash_04,
    "dash_05": dash_05,
    "dash_06": dash_06,
    "dash_07": dash_07,
    "dash_08": dash_08,
    "dash_09": dash_09,
    "dash_10": dash_10,
    "dash_11": dash_11,
    "dash_12": dash_12,
    "runbook_quarantine_day": runbook_quarantine_day,
    "star_fraud_by_month": star_fraud_by_month,
    "train_logreg_optimum": train_logreg_optimum,
    "train_score_logreg": train_score_logreg,
    "train_score_gbt": train_score_gbt,
}
