"""Parsing, rules, quarantine and deduplication."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.functions.rules import HARD_RULES
from tallywatch.operators.contract import BRONZE_SCHEMA, CONTRACT, expectation_metrics, quarantine, typed, valid_rows
from tallywatch.operators.dedup import first_arrivals, silver
from tallywatch.session import new_folder
from tallywatch.sources.feed import infer_fields, read_feed

GOOD = {
    "transaction_id": "t1",
    "event_ts": "2024-03-01T10:00:00",
    "customer_id": "C1",
    "merchant_id": "M1",
    "merchant_category": "cat1",
    "amount": "12.50",
    "currency": "USD",
    "country": "H1",
    "device_id": "D1",
    "channel": "pos",
    "is_fraud": "0",
    "fraud_type": None,
}


def bronze(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**GOOD, **change}
        rows.append(tuple(row[c] for c in CONTRACT) + (None, f"file{i:03d}"))
    names = [f.name for f in BRONZE_SCHEMA if f.name != "_ingested_at"]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("_ingested_at", F.timestamp_seconds(F.lit(0)))


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"amount": "-13.20"}, "valid_amount"),
        ({"amount": "0"}, "valid_amount"),
        ({"amount": "abc"}, "valid_amount"),
        ({"amount": "NaN"}, "valid_amount"),
        ({"amount": "Infinity"}, "valid_amount"),
        ({"amount": None, "transaction_id": None}, "valid_transaction_id, valid_amount"),
        ({"event_ts": "yesterday-ish"}, "valid_event_ts"),
        ({"customer_id": None}, "valid_customer"),
    ],
)
def test_hard_failures_are_quarantined_with_reasons(spark, change, reason):
    rows = bronze(spark, change)
    assert [r["_quarantine_reason"] for r in quarantine(typed(rows)).collect()] == [reason]
    assert silver(rows).isEmpty()


def test_soft_failures_stay_and_are_counted(spark):
    rows = bronze(spark, {"merchant_id": None}, {"transaction_id": "t2", "currency": None})
    assert silver(rows).count() == 2
    metrics = {r["rule"]: r for r in expectation_metrics(typed(rows)).collect()}
    assert metrics["known_merchant"]["failed_rows"] == 1
    assert metrics["known_currency"]["failed_rows"] == 1
    assert metrics["valid_amount"]["passed_rows"] == 2


def test_numeric_strings_are_accepted(spark):
    assert silver(bronze(spark, {"amount": "12.50"})).first()["amount"] == 12.5


def test_order_of_validation_and_deduplication(spark):
    rows = bronze(spark, {"amount": "-5.00"}, {"amount": "5.00"})
    assert [r["amount"] for r in silver(rows).collect()] == [5.0]
    assert silver(rows, validate_first=False).isEmpty()


def test_first_arrival_is_kept(spark):
    rows = bronze(spark, {"country": "first"}, {"country": "second"})
    assert [r["country"] for r in silver(rows).collect()] == ["first"]


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = bronze(spark, {})
    plan = first_arrivals(typed(rows), ["transaction_id"], [F.col("_ingested_at")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    partial, exchange = text.index("Partial"), text.index("Exchange")
    assert "WindowGroupLimit" in text and partial > exchange  # children are printed below


VALUES = st.fixed_dictionaries(
    {
        "transaction_id": st.sampled_from([None, "a", "b"]),
        "event_ts": st.sampled_from([None, "2024-03-01", "bad"]),
        "customer_id": st.sampled_from([None, "C1"]),
        "amount": st.sampled_from([None, "1", "-1", "NaN", "x", "1e3"]),
        "currency": st.sampled_from([None, "USD", "EUR"]),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VALUES, min_size=1, max_size=12))
def test_each_row_is_either_valid_or_quarantined(spark, changes):
    rows = typed(bronze(spark, *changes))
    good, bad = valid_rows(rows, HARD_RULES), quarantine(rows, HARD_RULES)
    assert good.count() + bad.count() == len(changes)
    assert bad.where("_quarantine_reason = ''").isEmpty()


def test_feed_rescues_what_does_not_fit(spark, tmp_path):
    lines = [
        json.dumps({**GOOD, "amount": 1.20, "is_fraud": 1}),
        json.dumps({**GOOD, "amount": "abc", "coupon": {"code": 7}}),
        json.dumps({**GOOD, "is_fraud": "maybe", "event_ts": "soon"}),
        "{not json",
        "",
    ]
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "day.jsonl").write_text("\n".join(lines) + "\n")
    rows = read_feed(spark, str(folder)).collect()
    assert len(rows) == 4
    by_rescue = {r["_rescued_data"]: r for r in rows}
    assert by_rescue[None]["amount"] == "1.2" or by_rescue[None]["amount"] == "1.20"
    assert '{"amount":"abc","coupon":"{\\"code\\":7}"}' in by_rescue
    assert '{"event_ts":"soon","is_fraud":"maybe"}' in by_rescue
    assert '{"_line":"{not json"}' in by_rescue
    assert all(r["_source_file"].endswith("day.jsonl") and r["_ingested_at"] for r in rows)
    assert typed(read_feed(spark, str(folder))).where("amount IS NULL").count() == 2
    assert infer_fields(spark, str(folder), 1.0)["currency"] == "string"


def test_new_folders_never_repeat(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
