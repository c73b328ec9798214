"""Cases that the fixture tables do not hold: old files, moved watermarks, shifted amounts, odd partition values."""

import datetime as dt
import json
import os

import pytest

from tallywatch.operators import gold
from tallywatch.operators.upsert import upsert_into
from tallywatch.plans.dashboard import fraud_amount_by_month, star_schema
from tallywatch.session import new_folder
from tallywatch.sources.tables import VersionedTable
from tallywatch.streaming import ingest


def put(folder, name, rows, age_days=0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as f:
        for key, ts in rows:
            row = {"transaction_id": key, "event_ts": ts, "customer_id": "C1", "merchant_id": "M1", "amount": 2.0, "currency": "USD"}
            f.write(json.dumps(row | {"country": "H1", "device_id": "D1", "channel": "pos", "is_fraud": 0}) + "\n")
    then = dt.datetime.now().timestamp() - age_days * 86_400
    os.utime(path, (then, then))


@pytest.fixture()
def layers(spark):
    return ingest.Layers(new_folder(spark, "verdict"))


def test_file_with_an_old_time_is_taken_in(spark, layers):
    put(layers.feed, "new", [("a", "2024-01-10T00:00:00")])
    ingest.run_update(spark, layers)
    put(layers.feed, "copied", [("b", "2024-01-10T01:00:00")], age_days=9)
    ingest.run_update(spark, layers)
    assert {r[0] for r in ingest.read_silver(spark, layers).select("transaction_id").collect()} == {"a", "b"}


def test_row_behind_a_watermark_moved_by_a_duplicate_is_kept_as_late(spark, layers):
    put(layers.feed, "1", [("1", "2024-01-10T00:00:00")])
    ingest.run_update(spark, layers)
    put(layers.feed, "2", [("1", "2024-01-11T12:00:00")])
    ingest.run_update(spark, layers)
    put(layers.feed, "3", [("2", "2024-01-09T00:00:00")])
    ingest.run_update(spark, layers)
    late = ingest.read_quarantine(spark, layers).select("transaction_id", "_quarantine_reason").collect()
    silver = {r[0] for r in ingest.read_silver(spark, layers).select("transaction_id").collect()}
    assert silver == {"1"} and [tuple(r) for r in late] == [("2", "late_event")]


def test_spread_of_large_amounts(spark):
    rows = [("C", "H", f"D{i % 3}", 1e9 + i % 3, dt.datetime(2024, 1, 1, 12), 0) for i in range(30)]
    frame = spark.createDataFrame(rows, "customer_id string, country string, device_id string, amount double, event_ts timestamp, is_fraud int")
    assert gold.customer_profiles(frame).first()["std_amount"] == 0.83


def test_star_join_counts_a_merchant_of_two_categories_once(spark):
    rows = [("M", c, dt.datetime(2024, 1, d), 5.0, 1) for c, d in (("x", 1), ("y", 2))]
    frame = spark.createDataFrame(rows, "merchant_id string, merchant_category string, event_ts timestamp, amount double, is_fraud int")
    found = fraud_amount_by_month(*star_schema(frame)).collect()
    assert [(r["category"], r["fraud_amount"]) for r in found] == [("y", 10.0)]


def test_upsert_into_partitions_with_escaped_names(spark):
    table = VersionedTable(spark, new_folder(spark, "odd"), "k string, v int, p string", "p")
    for v in (1, 2):
        upsert_into(table, spark.createDataFrame([("a", v, "a:b"), ("b", v, "50%")], "k string, v int, p string"), ["k"])
    assert sorted((r["k"], r["v"], r["p"]) for r in table.read().collect()) == [("a", 2, "a:b"), ("b", 2, "50%")]


def test_hot_route_with_an_id_used_by_two_customers(spark):
    from dataclasses import replace

    from tallywatch.config import DEFAULTS
    from tallywatch.operators.features import FEATURE_COLS, build_features

    ts = dt.datetime(2024, 1, 1, 12)
    rows = [("t1", c, "D", "H", 1.0, ts, "M", 0, "online") for c in ("a", "b")] + [("t2", c, "D", "H", 3.0, ts, "M", 0, "online") for c in ("a", "b")]
    ddl = "transaction_id string, customer_id string, device_id string, country string, amount double, event_ts timestamp, merchant_id string, is_fraud int, channel string"
    frame = spark.createDataFrame(rows, ddl)
    risk = spark.createDataFrame([("M", 0.1)], "merchant_id string, merchant_fraud_rate double")
    plain = build_features(frame, risk).select("transaction_id", "customer_id", *FEATURE_COLS)
    hot = build_features(frame, risk, replace(DEFAULTS, hot_group_rows=1)).select("transaction_id", "customer_id", *FEATURE_COLS)
    assert plain.count() == hot.count() == 4
    assert plain.exceptAll(hot).isEmpty()
