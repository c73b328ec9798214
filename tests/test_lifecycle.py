"""The stages together: two feed deliveries, training, scoring, monitoring, rollback."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallywatch.operators.training import TrainingPlan
from tallywatch.plans.lifecycle import Warehouse
from tallywatch.session import new_folder
from tallywatch.sources import fixtures
from tallywatch.streaming import ingest

SHORT = TrainingPlan(logistic_iterations=50, boosting_iterations=5, depth=3)


@pytest.fixture(scope="module")
def warehouse(spark):
    """Fed from the sf0.01 tables: the first 28 days, then the last two."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    lines = fixtures.feed_lines(spark, "/root/testdata/sf0.01")
    cut = F.lit(dt.date(2024, 1, 28))
    fixtures.write_feed(lines.where(F.col("feed_date") <= cut), house.layers.feed)
    house.update()
    fixtures.write_feed(lines.where(F.col("feed_date") > cut), house.layers.feed)
    house.update()
    return house


def test_incremental_update_matches_rebuild(warehouse):
    good, bad = warehouse.rebuilt()
    assert warehouse.silver().count() == good.count() == 9866
    rejected = ingest.read_quarantine(warehouse.spark, warehouse.layers)
    assert rejected.count() == bad.count() == 136


def test_second_run_over_same_files_adds_nothing(warehouse):
    before = warehouse.silver().count()
    assert warehouse.update() == {}
    assert warehouse.silver().count() == before


def test_daily_aggregate_refreshed_in_part_equals_full_one(warehouse):
    fresh = warehouse.full_refresh(new_folder(warehouse.spark, "fresh"))
    kept, full = warehouse.daily.read(), fresh.daily.read()
    assert kept.count() == full.count() == 30
    assert kept.exceptAll(full).isEmpty() and full.exceptAll(kept).isEmpty()
    before = fresh.silver().count()
    assert fresh.update() == {} and fresh.silver().count() == before == warehouse.silver().count()


def test_train_score_monitor_and_roll_back(warehouse):
    first = warehouse.train(SHORT)
    assert first["promoted"] == 1 and first["version"] == 1 and first["incumbent_pr_auc"] is None
    second = warehouse.train(SHORT)
    # the same data and settings give the same quality, and a tie promotes
    assert second["version"] == 2
    assert second["incumbent_pr_auc"] == pytest.approx(second["challenger_pr_auc"])
    assert warehouse.registry.resolve() == 2

    for date in ("2024-01-29", "2024-01-30", "2024-01-30"):
        warehouse.score(date)
    preds = warehouse.predictions.read()
    assert preds.count() == preds.select("transaction_id").distinct().count()
    assert [r[0] for r in preds.select("model_version").distinct().collect()] == [2]
    alerts = preds.where("is_alert = 1").groupBy("event_date").count()
    assert all(r["count"] <= 200 for r in alerts.collect())

    metrics = warehouse.monitor()
    assert metrics["monitor_date"] == "2024-01-30" and metrics["model_version"] == 2
    assert metrics["scored_count"] == preds.where("event_date = '2024-01-30'").count()
    warehouse.monitor()
    assert warehouse.monitoring.read().count() == 1

    total = preds.count()
    warehouse.roll_back(1, ["2024-01-30"])
    after = warehouse.predictions.read()
    assert after.count() == total
    versions = {r["event_date"]: r["v"] for r in after.groupBy("event_date").agg(F.max("model_version").alias("v")).collect()}
    assert versions == {dt.date(2024, 1, 29): 2, dt.date(2024, 1, 30): 1}
    with pytest.raises(ValueError, match="no version"):
        warehouse.registry.point(99)


def test_missing_day_is_an_error(warehouse):
    with pytest.raises(ValueError, match="no transactions found"):
        warehouse.score("2025-01-01", version=1)


def test_views_answer_sql(warehouse):
    names = warehouse.register_views()
    assert {"gold_daily_kpis", "silver_transactions", "ml_predictions", "ml_monitoring_metrics"} <= set(names)
    row = warehouse.spark.sql(
        "SELECT (SELECT count(*) FROM bronze_transactions) AS b, (SELECT count(*) FROM silver_transactions) AS s, "
        "(SELECT count(*) FROM silver_transactions_quarantine) AS q"
    ).first()
    assert (row["b"], row["s"], row["q"]) == (10048, 9866, 136)


# ---- streaming edge cases ---------------------------------------------------


def _line(transaction_id, event_ts, amount=1.0, **extra):
    row = {
        "transaction_id": transaction_id,
        "event_ts": event_ts,
        "customer_id": "C1",
        "merchant_id": "M1",
        "merchant_category": "cat1",
        "amount": amount,
        "currency": "USD",
        "country": "H1",
        "device_id": "D1",
        "channel": "pos",
        "is_fraud": 0,
        "fraud_type": None,
    }
    return json.dumps({**row, **extra})


def _deliver(spark, layers, day, lines):
    rows = spark.createDataFrame([(day, line) for line in lines], "feed_date string, value string")
    fixtures.write_feed(rows, layers.feed)


def _ids(df):
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())


def test_late_rows_go_to_quarantine(spark):
    layers = ingest.Layers(new_folder(spark, "late"))
    _deliver(spark, layers, "1", [_line("a", "2024-03-10T12:00:00.250"), _line("b", "2024-03-09T00:00:00")])
    counts = ingest.run_update(spark, layers)
    assert counts["rows"] == 2 and counts["valid_amount"] == 2 and counts["known_currency"] == 2
    late = [
        _line("exact", "2024-03-08T12:00:00.250"),  # on the watermark: too late
        _line("inside", "2024-03-08T12:00:00.251"),
        _line("old", "2024-03-01T00:00:00"),
        _line("b", "2024-03-01T00:00:00"),  # late, but its id is already clean
        _line("new", "2024-03-12T00:00:00"),
    ]
    _deliver(spark, layers, "2", late)
    ingest.run_update(spark, layers)
    assert _ids(ingest.read_silver(spark, layers)) == ["a", "b", "inside", "new"]
    rejected = ingest.read_quarantine(spark, layers)
    assert _ids(rejected) == ["exact", "old"]
    assert {r["_quarantine_reason"] for r in rejected.collect()} == {"late_event"}
    # a third run: the watermark has moved to 10 March
    _deliver(spark, layers, "3", [_line("later", "2024-03-09T23:00:00"), _line("fine", "2024-03-10T00:00:01")])
    ingest.run_update(spark, layers)
    assert _ids(ingest.read_silver(spark, layers)) == ["a", "b", "fine", "inside", "new"]
    assert _ids(ingest.read_quarantine(spark, layers)) == ["exact", "later", "old"]


def test_invalid_first_copy_does_not_hide_valid_one(spark):
    layers = ingest.Layers(new_folder(spark, "order"))
    _deliver(spark, layers, "1", [_line("x", "2024-03-10T12:00:00", -5.0), _line("x", "2024-03-10T12:00:00", 5.0)])
    ingest.run_update(spark, layers)
    assert [r["amount"] for r in ingest.read_silver(spark, layers).collect()] == [5.0]
    assert [r["amount"] for r in ingest.read_quarantine(spark, layers).collect()] == [-5.0]


def test_duplicates_across_runs_are_dropped(spark):
    layers = ingest.Layers(new_folder(spark, "copies"))
    for day in ("1", "2"):
        _deliver(spark, layers, day, [_line("x", "2024-03-10T12:00:00"), _line("x", "2024-03-10T12:00:00")])
        ingest.run_update(spark, layers)
    assert _ids(ingest.read_silver(spark, layers)) == ["x"]
    assert ingest.read_quarantine(spark, layers).isEmpty()


def test_counts_metrics_and_signature_are_stored(warehouse):
    stored = warehouse.tables()
    counts = stored["expectation_counts"].groupBy("rule").agg(F.sum("checked").alias("n"), F.count("*").alias("runs"))
    bronze = stored["bronze_transactions"].count()
    assert {(r["n"], r["runs"]) for r in counts.collect()} == {(bronze, 2)}
    if warehouse.registry.resolve() is None:
        warehouse.train(SHORT)
    metrics = warehouse.tables()["ml_candidate_metrics"].where("version = 1").collect()
    assert len(metrics) == 2 and all('"depth": 3' in r["parameters"] and r["roc_auc"] > 0 for r in metrics)
    with pytest.raises(ValueError, match="was fitted on"):
        warehouse.registry.load(1, ["amount"])
