"""The stages in order: update, refresh, train, score, monitor, roll back, rebuild."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.operators import gold
from tallywatch.operators.contract import quarantine, typed
from tallywatch.operators.daystate import CUSTOMER_DAYS_DDL, DEVICE_DAYS_DDL, DayStates, customer_days, device_days
from tallywatch.operators.dedup import silver as clean
from tallywatch.operators.evaluate import evaluate, promotion_gate
from tallywatch.operators.features import FEATURE_COLS, build_features, merchant_risk, split_bounds, time_split
from tallywatch.operators.monitoring import MONITORING_DDL, monitoring_rows, psi_band, score_baseline
from tallywatch.operators.scoring import PREDICTIONS_DDL, batch_score, on_date, resolve_date
from tallywatch.operators.training import TrainingPlan, fit_candidates, score_with
from tallywatch.operators.upsert import upsert_into
from tallywatch.plans.registry import Registry
from tallywatch.session import exists, written
from tallywatch.sources.feed import read_bronze
from tallywatch.sources.running import Aggregate, RunningTable
from tallywatch.sources.tables import VersionedTable
from tallywatch.streaming.ingest import Layers, merge_late, read_quarantine, read_rule_counts, read_silver, run_update, silver_batches

DAILY_DDL = (
    "txn_date DATE, txn_count BIGINT, total_amount DOUBLE, fraud_count BIGINT, "
    "fraud_amount DOUBLE, fraud_rate_pct DOUBLE, active_customers BIGINT"
)
WHOLE_HISTORY = {
    "gold_merchant_stats": Aggregate(gold.merchant_totals, gold.merge_merchants, gold.merchant_rates),
    "gold_customer_profiles": Aggregate(gold.customer_footprints, gold.merge_footprints, gold.footprint_profiles),
}


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    settings: Settings = DEFAULTS
    feed: str | None = None

    @property
    def layers(self) -> Layers:
        return Layers(self.root, self.feed)

    @property
    def registry(self) -> Registry:
        return Registry(self.spark, f"{self.root}/registry")

    @property
    def predictions(self) -> VersionedTable:
        ddl = f"{PREDICTIONS_DDL}, event_date DATE"
        return VersionedTable(self.spark, f"{self.root}/predictions", ddl, "event_date")

    @property
    def monitoring(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/monitoring", MONITORING_DDL, "monitor_date")

    def silver(self) -> DataFrame:
        return read_silver(self.spark, self.layers)

    @property
    def daily(self) -> VersionedTable:
        return VersionedTable(self.spark, self.layers.gold("gold_daily_kpis"), DAILY_DDL, "txn_date")

    @property
    def customer_days(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/customer_days", CUSTOMER_DAYS_DDL, "event_date")

    @property
    def device_days(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/device_days", DEVICE_DAYS_DDL, "event_date")

    def day_states(self) -> DayStates | None:
        """States for scoring; none in a warehouse that has not been refreshed since they exist."""
        if not self.device_days.partitions():
            return None
        return DayStates(self.customer_days.read(), self.device_days.read())

    def history(self, name: str) -> RunningTable:
        return RunningTable(self.spark, self.layers.gold(name), WHOLE_HISTORY[name])

    def update(self) -> dict[str, int]:
        """Take in new feed files, with their counts per rule, and refresh the aggregates."""
        counts = run_update(self.spark, self.layers, self.settings)
        self.refresh_gold()
        return counts

    def backfill(self, dates: list[str]) -> bool:
        """Move the late rows of some days from quarantine to Silver and refresh what they change."""
        merged = merge_late(self.spark, self.layers, dates) is not None
        days = self.silver().where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
        # also without new rows: a run may have stopped after the merge
        self.daily.replace(written(gold.daily_kpis(days), "daily"), dates)
        self._replace_states(days, dates)
        self._refresh_whole_history()
        return merged

    def refresh_gold(self) -> None:
        """Recompute the aggregates; for the daily one, only dates that may have changed.

        Silver takes no row further behind its newest event than the watermark
        delay, so after a refresh that reached some date, only dates from that
        delay before it can still change.
        """
        recent = self._may_have_changed(self.daily.partitions())
        daily = written(gold.daily_kpis(recent), "daily")
        dates = [str(row[0]) for row in daily.select("txn_date").collect()]  # one row per day
        self.daily.replace(daily, dates)
        recent = self._may_have_changed(self.device_days.partitions())
        self._replace_states(recent, [str(row[0]) for row in recent.select("event_date").distinct().collect()])  # one row per day
        self._refresh_whole_history()

    def _may_have_changed(self, done: list[str]) -> DataFrame:
        """Clean rows of the dates from the watermark's delay before the last date done."""
        if not done:
            return self.silver()
        since = dt.date.fromisoformat(done[-1]) - dt.timedelta(days=self.settings.watermark_days)
        return self.silver().where(F.col("event_date") >= F.lit(since))

    def _replace_states(self, days: DataFrame, dates: list[str]) -> None:
        # devices last: their dates say how far both tables are
        self.customer_days.replace(customer_days(days), dates)
        self.device_days.replace(device_days(days), dates)

    def _refresh_whole_history(self) -> None:
        """Merge the Silver batches that the stored states do not cover yet."""
        batches = silver_batches(self.spark, self.layers)
        for name in WHOLE_HISTORY:
            self.history(name).update(batches, lambda new: read_silver(self.spark, self.layers, new))

    def tables(self) -> dict[str, DataFrame]:
        """The tables that exist so far, under the names reports use."""
        stored = {
            "bronze_transactions": (self.layers.bronze, lambda p: read_bronze(self.spark, p)),
            "silver_transactions": (self.layers.silver, lambda p: self.silver()),
            "silver_transactions_quarantine": (
                self.layers.rejected,
                lambda p: read_quarantine(self.spark, self.layers),
            ),
            "expectation_counts": (self.layers.rule_counts, lambda p: read_rule_counts(self.spark, self.layers)),
            "ml_candidate_metrics": (f"{self.root}/candidate_metrics", self.spark.read.parquet),
            "gold_daily_kpis": (self.daily.path, lambda p: self.daily.read()),
            "ml_predictions": (self.predictions.path, lambda p: self.predictions.read()),
            "ml_monitoring_metrics": (self.monitoring.path, lambda p: self.monitoring.read()),
        }
        for name in WHOLE_HISTORY:
            stored[name] = (self.layers.gold(name), lambda p, name=name: self.history(name).read())
        found = {
            name: read(path) for name, (path, read) in stored.items() if exists(self.spark, path)
        }
        champion = self.registry.resolve()
        if champion is not None:
            found["ml_merchant_risk"] = self.risk_snapshot(champion)
            found["ml_score_baseline"] = self.baseline(champion)
        return found

    def register_views(self) -> list[str]:
        """Make the tables available to ``spark.sql`` by name."""
        found = self.tables()
        for name, df in found.items():
            df.createOrReplaceTempView(name)
        return sorted(found)

    def rebuilt(self) -> tuple[DataFrame, DataFrame]:
        """Clean and rejected rows recomputed from all of Bronze, late rows included."""
        bronze = read_bronze(self.spark, self.layers.bronze)
        return clean(bronze), quarantine(typed(bronze))

    def full_refresh(self, root: str) -> Warehouse:
        """Rebuild every table from the feed into a new folder, which then takes further updates.

        The streams run anew with checkpoints of their own, so the next ``update``
        goes on where they stopped; rows that were late before are not late in a
        run that sees them all.
        """
        fresh = replace(self, root=root, feed=self.layers.feed)
        fresh.update()
        return fresh

    def risk_snapshot(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/merchant_risk/version={version}")

    def baseline(self, version: int) -> DataFrame:
        """Baseline of a version; of the champion if the version was never promoted."""
        path = f"{self.root}/score_baseline/version={version}"
        if not exists(self.spark, path):
            path = f"{self.root}/score_baseline/version={self.registry.resolve()}"
        return self.spark.read.parquet(path)

    def train(self, plan: TrainingPlan = TrainingPlan()) -> dict:
        """Fit the candidates, register the better one, promote it if it wins.

        The metrics and parameters of all candidates are stored with the version.

        The risk snapshot and the score baseline are stored per version, so a
        champion that stays is still scored with its own.
        """
        txns = self.silver()
        split_date = split_bounds(txns, self.settings)
        rows = time_split(txns, split_date)
        risk = written(merchant_risk(rows.where("split = 'train'"), self.settings), "risk")
        features = written(time_split(build_features(txns, risk, self.settings), split_date), "features")
        train, test = features.where("split = 'train'"), features.where("split = 'test'")
        fitted = fit_candidates(train, plan)

        names = sorted(fitted)
        parts = [self._scored(test, name, score_with(fitted[name])) for name in names]
        champion = self.registry.resolve()
        incumbent = None if champion is None else f"version {champion}"
        if champion is not None:
            own = build_features(txns, self.risk_snapshot(champion), self.settings)
            own_test = time_split(own, split_date).where("split = 'test'")
            parts.append(self._scored(own_test, incumbent, score_with(self.registry.load(champion, FEATURE_COLS))))
        scored = written(reduce(DataFrame.unionByName, parts), "test-scores")
        metrics = written(evaluate(scored, self.settings), "candidate-metrics")
        gate = promotion_gate(metrics, names, incumbent, self.settings)
        decision = gate.first().asDict()

        winner = decision["challenger"]
        version = self.registry.register(
            fitted[winner], winner, decision["challenger_pr_auc"], FEATURE_COLS
        )
        metrics.withColumn("parameters", F.lit(json.dumps(asdict(plan)))).write.parquet(
            f"{self.root}/candidate_metrics/version={version}"
        )
        risk.write.parquet(f"{self.root}/merchant_risk/version={version}")
        if decision["promoted"]:
            won = scored.where(F.col("model") == winner)
            score_baseline(won, version, self.settings).write.parquet(
                f"{self.root}/score_baseline/version={version}"
            )
            self.registry.point(version)
        return {**decision, "version": version}

    @staticmethod
    def _scored(rows: DataFrame, name: str, scorer) -> DataFrame:
        return scorer(rows).select(
            F.lit(name).alias("model"), "transaction_id", "is_fraud", "fraud_score"
        )

    def score(
        self, date: str = "auto", version: int | None = None, keys_move: bool = False
    ) -> int:
        """Score a day with the champion, or with ``version``, and store it.

        Repeating a day, or re-scoring it after a rollback, replaces its rows.
        A clean row keeps its event time, so a prediction keeps its partition;
        say ``keys_move=True`` after a rebuild that may have changed that.
        """
        version = self.registry.resolve() if version is None else version
        if version is None:
            raise ValueError("no champion to score with")
        batch = batch_score(
            self.silver(),
            self.risk_snapshot(version),
            score_with(self.registry.load(version, FEATURE_COLS)),
            version,
            date,
            settings=self.settings,
            states=self.day_states(),
        ).withColumn("event_date", F.to_date("event_ts"))
        return upsert_into(
            self.predictions, written(batch, "batch"), ["transaction_id"], keys_move
        )

    def monitor(self, date: str = "auto") -> dict:
        """Store the metrics of a scored day and return them with the drift band."""
        preds = self.predictions.read()
        day = resolve_date(preds, date)
        today = on_date(preds, day)
        version = today.select(F.max("model_version")).first()[0]
        if version is None:
            raise ValueError(f"no predictions for {day}")
        # predictions carry the event time of the clean row, so its date is enough
        labels = on_date(self.silver(), day)
        rows = written(
            monitoring_rows(today, labels, self.baseline(version), settings=self.settings), "metrics"
        )
        upsert_into(self.monitoring, rows, ["monitor_date", "model_version"])
        return rows.withColumn("band", psi_band(F.col("psi"), self.settings)).first().asDict()

    def roll_back(self, version: int, dates: list[str]) -> None:
        """Point the champion at an older version and re-score the affected days."""
        self.registry.point(version)
        for date in dates:
            self.score(date)
