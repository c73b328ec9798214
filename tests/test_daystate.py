"""A day's features from the states of earlier days."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS
from tallywatch.operators.dates import between_dates
from tallywatch.operators.daystate import DayStates, customer_days, day_features, device_days
from tallywatch.operators.features import FEATURE_COLS
from tallywatch.operators.scoring import scoring_features
from tallywatch.session import written

DATE = dt.date(2024, 1, 20)
DDL = ("transaction_id string, event_ts timestamp, customer_id string, merchant_id string, amount double, country string, "
       "device_id string, channel string")  # fmt: skip


@pytest.fixture(scope="module")
def txns(spark):
    """Nulls in country, device, merchant and amount; crowded seconds; customers of one day, of the day before and of old days only."""
    r = random.Random(5)
    some = lambda *values: r.choice([None, *values])
    rows = []
    for i in range(900):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.choice([r.randrange(21 * 86_400), r.randrange(21 * 48) * 1800]))
        rows.append((f"t{i}", ts, r.choice("abcdaaa"), some("m1", "m2"), some(1.0, 2.5, 40.0), some("X", "Y"), some("d1", "d2", f"d{i % 40}"), "pos"))
    for i, (who, day) in enumerate([("new", 20), ("eve", 19), ("eve", 20), ("old", 2), ("old", 20), ("gone", 3), ("gone", 18), ("edge", 18), ("edge", 20)]):
        rows.append((f"x{i}", dt.datetime(2024, 1, day, 12), who, "m1", 3.0, "X", "d1", "online"))
    return written(spark.createDataFrame(rows, DDL), "txns")


@pytest.mark.parametrize("lookback", [30, 5, 2, 1, None])
@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_equal_to_the_whole_look_back(spark, txns, lookback, hot):
    settings = replace(DEFAULTS, lookback_days=lookback, hot_group_rows=hot, max_broadcast_rows=hot)
    risk = spark.createDataFrame([("m1", 0.25)], "merchant_id string, merchant_fraud_rate double")
    states = DayStates(written(customer_days(txns), "customer-days"), written(device_days(txns), "device-days"))
    shown = ["transaction_id", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in FEATURE_COLS]]
    want = scoring_features(txns, risk, DATE, settings).select(*shown)
    # the rows of earlier days are not even there
    two_days = between_dates(txns, DATE - dt.timedelta(days=2), DATE)
    got = day_features(two_days, states, risk, DATE, settings).select(*shown)
    assert got.count() == want.count() > 30
    assert got.exceptAll(want).isEmpty()


def test_empty_day_and_no_states(spark, txns):
    states = DayStates(customer_days(txns).limit(0), device_days(txns).limit(0))
    risk = spark.createDataFrame([], "merchant_id string, merchant_fraud_rate double")
    assert day_features(txns, states, risk, dt.date(2025, 1, 1)).isEmpty()
    first = dt.date(2024, 1, 1)
    got, want = (rows.select("transaction_id", *FEATURE_COLS) for rows in (day_features(txns, states, risk, first), scoring_features(txns, risk, first)))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0
