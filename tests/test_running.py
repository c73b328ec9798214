"""Aggregates that grow by merging partial states."""

import datetime as dt
import random

from pyspark.sql import functions as F
from test_verdict import put

from tallywatch.operators import gold
from tallywatch.plans.lifecycle import WHOLE_HISTORY, Warehouse
from tallywatch.session import child_names, new_folder
from tallywatch.sources import fixtures
from tallywatch.sources.running import KEPT, RunningTable

DDL = ("batch string, customer_id string, country string, device_id string, merchant_id string, merchant_category string, "
       "amount double, event_ts timestamp, is_fraud int")  # fmt: skip
WHOLE = {"gold_merchant_stats": gold.merchant_stats, "gold_customer_profiles": gold.customer_profiles}


def rows(seed, batches=5, n=400):
    """Nulls in every key and value, large amounts with a small spread, customers seen in one batch only."""
    r = random.Random(seed)
    some = lambda *values: r.choice([None, *values])
    return [
        (
            str(i % batches), some("a", "b", f"only{i % batches}"), some("X", "Y"), some("d1", "d2"), some("m1", "m2"), some("c1"),
            some(1e9 + i % 3, 1e9 + 1.5), some(dt.datetime(2024, 1, 1 + i % 20, i % 24)), some(0, 1),
        )
        for i in range(n)
    ]


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_merged_states_equal_the_whole(spark):
    frame = spark.createDataFrame(rows(1), DDL).cache()
    for name, whole in WHOLE.items():
        table = RunningTable(spark, new_folder(spark, "running"), WHOLE_HISTORY[name])
        for nth in range(1, 6):
            new = table.update([str(b) for b in range(nth)], lambda new: frame.where(F.col("batch").isin(new)))
            assert new == [str(nth - 1)]
            assert same(table.read(), whole(frame.where(F.col("batch") < str(nth))))
        assert table.update([str(b) for b in range(5)], None) == []
        assert len(child_names(spark, table.path)) == KEPT


def test_empty_first_batch(spark):
    empty = spark.createDataFrame([], DDL)
    table = RunningTable(spark, new_folder(spark, "running"), WHOLE_HISTORY["gold_customer_profiles"])
    assert table.update([], lambda new: empty) == [] and table.read().isEmpty()
    frame = spark.createDataFrame(rows(2), DDL)
    assert table.update(["0"], lambda new: frame) == ["0"] and same(table.read(), gold.customer_profiles(frame))


def test_a_stopped_update_is_not_read_and_done_again(spark):
    frame = spark.createDataFrame(rows(3, batches=2), DDL).cache()
    table = RunningTable(spark, new_folder(spark, "running"), WHOLE_HISTORY["gold_merchant_stats"])
    read = lambda new: frame.where(F.col("batch").isin(new))
    table.update(["0"], read)
    # a driver that stopped before the list of covered batches was written
    frame.write.parquet(f"{table.path}/version=2/state")
    assert table.latest() == 1 and same(table.read(), gold.merchant_stats(read(["0"])))
    assert table.update(["0", "1"], read) == ["1"] and same(table.read(), gold.merchant_stats(frame))


def test_only_new_batches_of_clean_rows_are_read(spark):
    house = Warehouse(spark, new_folder(spark, "house"))
    put(house.layers.feed, "1", [("a", "2024-01-13T00:00:00")])
    house.update()
    put(house.layers.feed, "2", [("b", "2024-01-13T01:00:00"), ("x", "2024-01-09T00:00:00")])
    house.update()
    before = house.history("gold_customer_profiles").covered()
    assert house.tables()["gold_customer_profiles"].first()["txn_count"] == 2
    assert house.backfill(["2024-01-09"])
    after = house.history("gold_customer_profiles").covered()
    assert [b for b in after if b not in before] == ["batch=late-00000000"]
    tables = house.tables()
    assert tables["gold_customer_profiles"].first()["txn_count"] == tables["gold_merchant_stats"].first()["txn_count"] == 3
    version = house.history("gold_merchant_stats").latest()
    house.update()
    assert house.history("gold_merchant_stats").latest() == version


def test_repeated_lines_and_orders_make_one_transaction_of_numbers_dealt_once(spark, tmp_path):
    day = dt.date(1995, 1, 2)
    lines = [(o, n, day + dt.timedelta(d), 10.0 * (o or 0) + (n or 0), 1.0, 3, s, "R", "O") for o in (1, 2, 3, None) for n in (1, 2, None) for d, s in ((1, 9), (0, 10), (0, 9))]
    columns = "l_orderkey long, l_linenumber int, l_shipdate date, l_extendedprice double, l_quantity double, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, day), (1, 7, day), (2, None, day)], "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    found = fixtures.order_transactions(spark, str(tmp_path))
    got = sorted((r["transaction_id"], r["customer_id"], r["merchant_id"], r["amount"]) for r in found.select("*").collect())
    # Of the earliest copies the merchant first in the order of texts: M10 before M9.
    assert [(t, c, m) for t, c, m, _ in got] == [(f"{o}{n}", c, "M10") for o, c in ((1, "C7"), (2, None)) for n in ("", "-1", "-2")]
    assert [a for *_, a in got] == [10.0, 11.0, 12.0, 20.0, 21.0, 22.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(transaction_id" not in plan
