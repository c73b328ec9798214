"""Features: golden rows, brute force, both routes, no look-ahead."""

import hashlib
import random
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS
from tallywatch.operators.features import FEATURE_COLS, build_features, merchant_risk, split_bounds, time_split
from tallywatch.operators.skew import heavy_keys, lookup

DDL = (
    "transaction_id string, event_ts timestamp, customer_id string, merchant_id string, amount double, "
    "country string, device_id string, channel string, is_fraud int"
)
HOT = replace(DEFAULTS, hot_group_rows=5, max_broadcast_rows=2)


def rows(spark, values):
    """(id, second, customer, merchant, amount, country, device)"""
    data = [(i, float(s), c, m, a, n, d) for i, s, c, m, a, n, d in values]
    names = "transaction_id string, sec double, customer_id string, merchant_id string, amount double, country string, device_id string"
    frame = spark.createDataFrame(data, names)
    return frame.select(
        "transaction_id",
        F.timestamp_seconds("sec").alias("event_ts"),
        "customer_id",
        "merchant_id",
        "amount",
        "country",
        "device_id",
        F.lit("pos").alias("channel"),
        F.lit(0).alias("is_fraud"),
    )


@pytest.fixture(scope="module")
def risk(spark):
    return spark.createDataFrame(
        [("M1", 0.25), ("M2", 0.5), ("M3", 0.75)], "merchant_id string, merchant_fraud_rate double"
    )


def test_golden_frames(spark, risk):
    # ids chosen so that the hash order of the tie is the listed order
    first, second = sorted("ab", key=lambda x: hashlib.md5(x.encode()).hexdigest())
    txns = rows(
        spark,
        [
            (first, 1, "C", "M1", 10.0, "H", "D"),
            (second, 1, "C", None, 20.0, "F", "D"),
            ("c", 2, "C", "M9", 30.0, "H", "E"),
            ("d", 4000, "C", "M2", 5.0, "H", "D"),
        ],
    )
    got = {r["transaction_id"]: r for r in build_features(txns, risk).collect()}
    ordered = [got[i] for i in (first, second, "c", "d")]
    assert [r["txn_count_1h"] for r in ordered] == [0, 0, 2, 0]
    assert [r["txn_count_24h"] for r in ordered] == [0, 0, 2, 3]
    assert [r["amount_over_avg"] for r in ordered] == [1.0, 2.0, 2.0, 0.25]
    assert [r["seconds_since_prev_txn"] for r in ordered] == [2592000, 0, 1, 3998]
    assert [r["is_new_device"] for r in ordered] == [1, 0, 1, 0]
    assert [r["is_foreign"] for r in ordered] == [0, 1, 0, 0]
    assert [r["merchant_fraud_rate"] for r in ordered] == [0.25, 0.0, 0.0, 0.5]
    assert [r["is_night"] for r in ordered] == [1, 1, 1, 1]


def test_log_amount_and_velocity_examples(spark, risk):
    txns = rows(spark, [(str(i), 60 * i, "C", "M1", 1.20, "H", "D") for i in range(9)])
    got = {r["transaction_id"]: r for r in build_features(txns, risk).collect()}
    assert round(got["0"]["log_amount"], 2) == 0.79
    assert got["8"]["txn_count_1h"] == 8


def random_rows(seed, n=260):
    r = random.Random(seed)
    values = []
    for i in range(n):
        # one customer has most rows, with crowded seconds and gaps over days
        customer = "hot" if r.random() < 0.7 else f"C{r.randrange(4)}"
        second = r.choice([0, 5, 3600, 3605, 86400, 90000, 90001, 500000, r.randrange(10 * 86400)])
        values.append(
            (
                f"id{i}",
                float(second) + r.choice([0.0, 0.25, 0.5]),
                customer,
                r.choice([None, "M1", "M2", "M3", "M4"]),
                float(r.randrange(1, 2000)) / 4,
                r.choice([None, "H", "F"]),
                r.choice([None, "D", "E", f"X{r.randrange(40)}"]),
            )
        )
    return values


def brute_force(values, rates):
    """The definitions, row by row."""
    tie = {v[0]: hashlib.md5(v[0].encode()).hexdigest()[:15] for v in values}
    out = {}
    for i, s, c, m, a, country, device in values:
        sec = int(s // 1)
        mine = [v for v in values if v[2] == c]
        before = [v for v in mine if (int(v[1] // 1), tie[v[0]]) < (sec, tie[i])]
        before.sort(key=lambda v: (int(v[1] // 1), tie[v[0]]))
        home = before[0][5] if before else country
        prior = [v[4] for v in before]
        gaps = [sec - int(v[1] // 1) for v in mine]
        out[i] = {
            "amount": a,
            "is_foreign": None if country is None or home is None else int(country != home),
            "is_new_device": int(not any(v[6] == device for v in before)),
            "txn_count_1h": sum(1 <= g <= 3600 for g in gaps),
            "txn_count_24h": sum(1 <= g <= 86400 for g in gaps),
            "amount_over_avg": a / (sum(prior) / len(prior)) if prior else 1.0,
            "seconds_since_prev_txn": sec - int(before[-1][1] // 1) if before else 2592000,
            "merchant_fraud_rate": rates.get(m, 0.0),
            "hour": (sec // 3600) % 24,
        }
    return out


@pytest.mark.parametrize("settings", [DEFAULTS, HOT], ids=["windows", "decomposed"])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, risk, settings, seed):
    values = random_rows(seed)
    txns = rows(spark, values).cache()
    got = {r["transaction_id"]: r.asDict() for r in build_features(txns, risk, settings).collect()}
    want = brute_force(values, {"M1": 0.25, "M2": 0.5, "M3": 0.75})
    assert len(got) == len(values)
    for key, expected in want.items():
        actual = {c: got[key][c] for c in expected}
        assert actual == pytest.approx(expected), key


def test_future_rows_change_nothing(spark, risk):
    values = [v for v in random_rows(3) if v[1] < 400000]
    later = [(f"later{i}", 400000.0 + i, c, "M1", 9.0, "F", "new") for i, c in enumerate(["hot", "C1"] * 5)]
    before = build_features(rows(spark, values), risk).toPandas()
    after = build_features(rows(spark, values + later), risk).toPandas()
    after = after[~after.transaction_id.str.startswith("later")]
    sort = lambda f: f.sort_values("transaction_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(sort(before), sort(after))


def test_windows_share_one_shuffle(spark, risk):
    txns = rows(spark, random_rows(4))
    plan = build_features(txns, risk)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(customer_id") == 1
    assert "SinglePartition" not in plan


def test_heavy_keys_are_few_and_complete(spark):
    frame = spark.createDataFrame([("a",)] * 9 + [("b",)] * 7 + [("c",)] * 2 + [(None,)] * 20, "k string")
    assert [r["k"] for r in heavy_keys(frame, "k", HOT).orderBy("k").collect()] == ["a", "b"]


def test_lookup_routes_agree(spark, risk):
    facts = spark.createDataFrame(
        [(str(i), k) for i, k in enumerate(["M1"] * 12 + ["M2"] * 2 + [None] * 9 + ["M8"])], "id string, merchant_id string"
    )
    plain = lookup(facts, risk, "merchant_id", F.col("id"))
    salted = lookup(facts, risk, "merchant_id", F.col("id"), HOT)
    assert sorted(plain.columns) == sorted(salted.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))
    assert plain.count() == 24


def test_split_and_risk(spark):
    day = 86400.0
    txns = rows(spark, [("a", 0.0, "C", "M", 1.0, "H", "D"), ("b", 24 * day, "C", "M", 1.0, "H", "D"), ("c", 25 * day, "C", "M", 1.0, "H", "D")])
    got = {r["transaction_id"]: r["split"] for r in time_split(txns, split_bounds(txns)).collect()}
    assert got == {"a": "train", "b": "train", "c": "test"}
    rate = merchant_risk(txns).first()["merchant_fraud_rate"]
    assert rate == pytest.approx(1 / 203)


def test_feature_columns_are_all_there(spark, risk):
    frame = build_features(rows(spark, random_rows(5, 10)), risk)
    assert set(FEATURE_COLS) <= set(frame.columns)
    assert not [c for c in frame.columns if c.startswith("_")]
