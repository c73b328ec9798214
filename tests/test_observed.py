"""Observed types of a feed, and sums over many groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.operators.contract import CONTRACT
from tallywatch.operators.observed import observed_types
from tallywatch.operators.prefix import sums_before


def observed(spark, *lines):
    rows = observed_types(spark.createDataFrame([(line,) for line in lines], "value string")).collect()
    return {r["field"]: r for r in rows}


def test_one_odd_value_shows(spark):
    got = observed(spark, *['{"is_fraud":0,"amount":1}'] * 2000, '{"is_fraud":"x","amount":2.5}')
    assert got["is_fraud"]["merged"] == "text" and got["is_fraud"]["misfits"] == 1 and got["is_fraud"]["contract"] == "int"
    assert got["amount"]["merged"] == "number" and (got["amount"]["integers"], got["amount"]["numbers"]) == (2000, 1)


@pytest.mark.parametrize(
    ("values", "merged"),
    [
        (["null"], "null"), (["1", "null"], "integer"), (["1", "2.5"], "number"), (["1e300"], "number"), (["true"], "boolean"),
        (["true", "1"], "text"), (["{}", "[1]"], "nested"), (["[1]", "2"], "text"), (['"1"', "1"], "text"),
    ],
)
def test_kinds_are_joined(spark, values, merged):
    got = observed(spark, *[f'{{"a":{v}}}' for v in values])["a"]
    assert got["merged"] == merged and got["contract"] is None and got["misfits"] == sum(v != "null" for v in values)


def test_lines_that_are_no_objects(spark):
    got = observed(spark, None, "", "nope", "[1]", "3", "null", '{"amount":', "{}")
    assert set(got) == set(CONTRACT)
    assert all(r["merged"] == "null" and r["texts"] == r["misfits"] == 0 for r in got.values())
    assert set(observed(spark)) == set(CONTRACT)


def test_values_that_the_contract_rejects(spark):
    got = observed(spark, '{"event_ts":"2024-13-01","is_fraud":99999999999,"amount":"N/A"}', '{"event_ts":"2024-01-01","is_fraud":1,"amount":"1.5"}')
    assert [got[name]["misfits"] for name in ("event_ts", "is_fraud", "amount")] == [1, 1, 1]


def test_sums_over_a_million_groups(spark):
    n = 1_000_000
    value = F.pmod(F.xxhash64("id"), F.lit(7))
    rows = spark.range(n).select(F.lit("m").alias("model"), F.col("id").alias("bucket"), value.alias("pos")).where("bucket % 10 <> 3")
    summed = sums_before(rows, ["model"], "bucket", ["pos"], n)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "_bucket" in plan
    got = summed.orderBy("bucket").toPandas()
    assert len(got) == 900_000 and list(got.columns) == ["model", "bucket", "pos", "pos_above"]
    assert (got["pos_above"].to_numpy() == np.cumsum(got["pos"].to_numpy()) - got["pos"].to_numpy()).all()


@pytest.mark.parametrize("fanout", [2, 3, 50])
def test_sums_per_key(spark, fanout):
    data = [(k, p, p * p + (k == "b")) for k in ("a", "b") for p in range(0, 40, 3)]
    got = sums_before(spark.createDataFrame(data, "model string, bucket int, pos long"), ["model"], "bucket", ["pos"], 40, fanout)
    want = {(k, p): sum(v for a, q, v in data if a == k and q < p) for k, p, _ in data}
    assert {(r["model"], r["bucket"]): r["pos_above"] for r in got.collect()} == want
