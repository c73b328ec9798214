"""Metrics, gate, weights, drift, alerts and upserts on small inputs."""

import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS
from tallywatch.functions.expressions import bin_edges, bin_index, stable_round
from tallywatch.operators import evaluate, gold, monitoring, scoring
from tallywatch.operators.upsert import require_unique, upsert, upsert_into
from tallywatch.plans import dashboard
from tallywatch.session import new_folder
from tallywatch.sources import tables

SCORED = "model string, transaction_id string, is_fraud int, fraud_score double"


def brute_metrics(pairs, max_fpr=0.005):
    pos = sum(y for y, _ in pairs)
    neg = len(pairs) - pos
    area, best, last = 0.0, 0.0, 0.0
    for cut in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(y for y, s in pairs if s >= cut)
        fp = sum(1 - y for y, s in pairs if s >= cut)
        area += (tp / pos - last) * tp / (tp + fp)
        last = tp / pos
        if fp / neg <= max_fpr:
            best = max(best, tp / pos)
    wins = sum((s > t) + 0.5 * (s == t) for y, s in pairs if y for z, t in pairs if not z)
    return area, wins / (pos * neg), best


@pytest.mark.parametrize("buckets", [2, 7, 512])
def test_metrics_match_brute_force(spark, buckets):
    r = random.Random(buckets)
    pairs = {
        "tied": [(int(r.random() < 0.2), round(r.random(), 1)) for _ in range(150)] + [(1, 0.5), (0, 0.5)],
        "spread": [(int(r.random() < 0.1), r.random() ** 6) for _ in range(300)] + [(1, 1.0), (0, 0.0)],
        "perfect": [(1, 0.9)] * 3 + [(0, 0.1)] * 5,
    }
    data = [(m, f"{m}{i}", y, s) for m, rows in pairs.items() for i, (y, s) in enumerate(rows)]
    frame = spark.createDataFrame(data, SCORED)
    small = replace(DEFAULTS, bucket_rows=buckets, prefix_fanout=3, max_daily_alerts=10)
    got = {r["model"]: r for r in evaluate.evaluate(frame, small).collect()}
    for model, rows in pairs.items():
        want = brute_metrics(rows)
        assert (got[model]["pr_auc"], got[model]["roc_auc"], got[model]["recall_at_fpr"]) == pytest.approx(want)
    ordered = sorted([(-s, f"spread{i}", y) for i, (y, s) in enumerate(pairs["spread"])])[:10]
    assert got["spread"]["precision_at_k"] == pytest.approx(sum(y for *_, y in ordered) / 10)


def test_curve_has_no_single_task_window(spark):
    frame = spark.createDataFrame([("m", str(i), i % 2, i / 50) for i in range(50)], SCORED)
    plan = evaluate.threshold_curve(frame)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_class_weight_example(spark):
    frame = spark.range(1000).withColumn("is_fraud", (F.col("id") < 4).cast("int"))
    weights = evaluate.class_weights(frame).groupBy("is_fraud").agg(F.max("weight").alias("w"))
    got = {r["is_fraud"]: r["w"] for r in weights.collect()}
    assert got[1] == pytest.approx(249) and got[0] == 1.0


@pytest.mark.parametrize(
    ("challenger", "incumbent", "gain", "promoted"),
    [(0.81, 0.83, 0.0, 0), (0.83, 0.83, 0.0, 1), (0.84, 0.83, 0.02, 0), (0.84, 0.83, 0.0, 1), (0.1, None, 0.0, 1)],
)
def test_promotion_gate(spark, challenger, incumbent, gain, promoted):
    rows = [("a", challenger), ("b", challenger - 0.05)]
    if incumbent is not None:
        rows.append(("champion", incumbent))
    metrics = spark.createDataFrame(rows, "model string, pr_auc double")
    name = None if incumbent is None else "champion"
    row = evaluate.promotion_gate(metrics, ["a", "b"], name, replace(DEFAULTS, min_promotion_gain=gain)).first()
    assert (row["challenger"], row["promoted"]) == ("a", promoted)


def test_psi_example(spark):
    pairs = zip([0.70, 0.15, 0.08, 0.05, 0.02], [0.55, 0.20, 0.10, 0.09, 0.06])
    frame = spark.createDataFrame(list(pairs), "e double, a double")
    psi = frame.agg(F.sum(monitoring.psi_term(F.col("a"), F.col("e")))).first()[0]
    assert psi == pytest.approx(0.122, abs=1e-3)


def test_psi_bands(spark):
    frame = spark.createDataFrame([(0.0,), (0.1,), (0.2,)], "psi double")
    bands = [r[0] for r in frame.select(monitoring.psi_band(F.col("psi"))).collect()]
    assert bands == ["STABLE", "WATCH", "DRIFT"]


def test_histogram_edges(spark):
    scores = [0.0, 0.1, 0.3, 0.6, 0.7, 1.0, -0.1, 1.1, None, 3 * 0.1]
    frame = spark.createDataFrame([(s,) for s in scores], "fraud_score double")
    edges = bin_edges(10)
    want = [
        None if s is None or not 0 <= s <= 1 else max(i for i in range(10) if edges[i] <= s) for s in scores
    ]
    assert [r[0] for r in frame.select(bin_index(F.col("fraud_score"), 10)).collect()] == want
    rows = monitoring.score_histogram(frame).orderBy("bin").collect()
    assert len(rows) == 10 and sum(r["n"] for r in rows) == 7
    assert sum(r["fraction"] for r in rows) == pytest.approx(1.0)


PREDS = "transaction_id string, event_ts timestamp, is_alert int, fraud_score double, model_version int"


def test_effectiveness_example(spark):
    stamp = F.timestamp_seconds(F.lit(0))
    ids = spark.range(300).select(F.col("id").cast("string").alias("transaction_id"), "id", stamp.alias("event_ts"))
    preds = ids.withColumn("is_alert", (F.col("id") < 250).cast("int"))
    labels = ids.withColumn("is_fraud", ((F.col("id") < 150) | (F.col("id") >= 250)).cast("int"))
    row = monitoring.effectiveness(preds, labels).first()
    assert (row["alert_precision"], row["fraud_recall"]) == (pytest.approx(0.60), pytest.approx(0.75))


def test_monitoring_without_alerts_or_labels(spark):
    preds = spark.createDataFrame([("a", None, 0, 0.2, 1)], PREDS).withColumn("event_ts", F.timestamp_seconds(F.lit(0)))
    labels = spark.createDataFrame([], "transaction_id string, is_fraud int")
    baseline = monitoring.score_baseline(preds, 1)
    row = monitoring.monitoring_rows(preds, labels, baseline).first()
    assert row["scored_count"] == 0 and row["alert_precision"] is None and row["psi"] == pytest.approx(0)


def test_alert_budget(spark):
    day = F.timestamp_seconds(F.when(F.col("id") < 50, 0).otherwise(86400))
    frame = spark.range(100).select(
        F.col("id").cast("string").alias("transaction_id"),
        day.alias("event_ts"),
        F.lit("C").alias("customer_id"),
        F.lit(1.0).alias("amount"),
        F.when(F.col("id") % 5 == 0, 0.9).when(F.col("id") % 5 == 1, 0.5).otherwise(0.499).alias("fraud_score"),
    )
    flagged = scoring.flag_alerts(frame, replace(DEFAULTS, max_daily_alerts=12)).where("is_alert = 1")
    rows = flagged.select("transaction_id", "event_ts", "fraud_score").collect()
    first_day = sorted((-r["fraud_score"], r["transaction_id"]) for r in rows if int(r["transaction_id"]) < 50)
    assert len(rows) == 24 and len(first_day) == 12
    assert sum(s == -0.9 for s, _ in first_day) == 10
    assert [i for s, i in first_day if s == -0.5] == sorted(str(i) for i in range(1, 50, 5))[:2]


def test_rank_is_limited_before_the_shuffle(spark):
    frame = spark.createDataFrame(
        [("a", None, "C", 1.0, 0.9)], "transaction_id string, event_ts timestamp, customer_id string, amount double, fraud_score double"
    )
    assert "WindowGroupLimit" in scoring.flag_alerts(frame)._jdf.queryExecution().executedPlan().toString()


# ---- upserts -----------------------------------------------------------------

ROWS = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 3), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_upsert_replaces_and_is_idempotent(spark, target, batch):
    frame = lambda rows: spark.createDataFrame(list(rows.items()), "k string, v long")
    once = upsert(frame(target), frame(batch), ["k"])
    assert dict(map(tuple, once.collect())) == {**target, **batch}
    twice = upsert(once, frame(batch), ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted({**target, **batch}.items())


def test_upsert_refuses_repeated_keys(spark):
    with pytest.raises(ValueError, match="several rows"):
        require_unique(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), ["k"])


def test_stored_upsert_moves_keys_and_keeps_versions(spark):
    table = tables.VersionedTable(spark, new_folder(spark, "table"), "k string, v int, day date", "day")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, day string").withColumn("day", F.to_date("day"))
    assert table.latest() == 0 and table.read().isEmpty()
    upsert_into(table, frame([("a", 1, "2024-01-01"), ("b", 1, "2024-01-01"), ("c", 1, "2024-01-02"), ("n", 1, None)]), ["k"])
    # a moves to another day, b stays, c is untouched
    upsert_into(table, frame([("a", 2, "2024-01-03"), ("n", 2, None)]), ["k"])
    got = {r["k"]: (r["v"], r["day"] and str(r["day"])) for r in table.read().collect()}
    assert got == {"a": (2, "2024-01-03"), "b": (1, "2024-01-01"), "c": (1, "2024-01-02"), "n": (2, None)}
    folders = table._pointers(2)
    assert folders["2024-01-02"] == table._pointers(1)["2024-01-02"]
    # moving the only row of a day empties that day
    upsert_into(table, frame([("c", 3, "2024-01-01")]), ["k"])
    assert "2024-01-02" not in table.partitions() and table.read().count() == 4
    with pytest.raises(ValueError, match="outside the replaced"):
        table.replace(frame([("z", 1, "2030-01-01")]), ["2024-01-01"])


def test_large_partitions_are_split_when_written(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, v int").hint("rebalance", "k")
    assert "REBALANCE" in frame._jdf.queryExecution().executedPlan().toString()


def test_reports_on_empty_predictions(spark):
    preds = spark.createDataFrame([], scoring.PREDICTIONS_DDL)
    assert dashboard.score_distribution(preds).isEmpty()


def test_latest_date_prunes_partitions(spark):
    table = tables.VersionedTable(spark, new_folder(spark, "preds"), f"{PREDS}, event_date date", "event_date")
    stamps = spark.range(3).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.timestamp_seconds(F.col("id") * 86400).alias("event_ts"),
        F.lit(1).alias("is_alert"),
        F.lit(0.9).alias("fraud_score"),
        F.lit(1).alias("model_version"),
    )
    upsert_into(table, stamps.withColumn("event_date", F.to_date("event_ts")), ["transaction_id"])
    report = dashboard.score_distribution(table.read())
    assert [tuple(r) for r in report.collect()] == [(0.9, 1)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_catalog_tables(spark):
    tables.create_schema(spark, "cards")
    tables.create_table(spark, "cards.preds", "k string, v int", "scores")
    tables.create_table(spark, "cards.preds", "k string, v int", "scores")
    assert spark.table("cards.preds").isEmpty()
    frame = spark.createDataFrame([("a", 1)], "k string, v int")
    tables.overwrite_table(frame, "cards.daily", "per day", "gold")
    tables.overwrite_table(frame, "cards.daily", "per day", "gold")
    assert spark.table("cards.daily").count() == 1
    details = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED cards.daily").collect()}
    assert details["Comment"] == "per day" and "quality=gold" in details["Table Properties"]


# ---- aggregates ----------------------------------------------------------------


def test_customer_profiles(spark):
    rows = [
        ("C", 10.0, "H", "D1", 3600), ("C", 20.0, "H", "D2", 30000), ("C", 60.0, "F", "D1", 90000),
        ("S", 5.0, None, None, 100),
    ]
    frame = spark.createDataFrame(rows, "customer_id string, amount double, country string, device_id string, s long")
    frame = frame.withColumn("event_ts", F.timestamp_seconds("s"))
    got = {r["customer_id"]: r for r in gold.customer_profiles(frame).collect()}
    c, s = got["C"], got["S"]
    assert (c["txn_count"], c["avg_amount"], c["std_amount"]) == (3, 30.0, 26.46)
    assert (c["distinct_countries"], c["distinct_devices"], c["night_txn_ratio"]) == (2, 2, 0.6667)
    assert (s["std_amount"], s["distinct_countries"], s["distinct_devices"]) == (None, 0, 0)


def test_stable_round_ignores_noise(spark):
    frame = spark.createDataFrame([(1.0049999999999999,), (0.1 + 0.2,), (float("inf"),), (1e300,), (None,)], "x double")
    got = [r[0] for r in frame.select(stable_round(F.col("x"), 2)).collect()]
    assert got == [1.01, 0.3, float("inf"), 1e300, None]
