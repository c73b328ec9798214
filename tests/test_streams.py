"""Streams that stop, repeat ids and get days late."""

import datetime as dt

import pytest
from test_verdict import put

from pyspark.sql import functions as F

from tallywatch.session import new_folder
from tallywatch.streaming import ingest
from tallywatch.streaming.uniqueness import id_filters, unseen


@pytest.fixture()
def layers(spark):
    return ingest.Layers(new_folder(spark, "streams"))


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


@pytest.mark.parametrize("stages", [1, 2, 3])
def test_a_stop_after_any_stage_loses_no_late_row(spark, layers, stages):
    for nth, row in enumerate([("a", "2024-01-10T00:00:00"), ("b", "2024-01-13T00:00:00")]):
        put(layers.feed, str(nth), [row])
        ingest.run_update(spark, layers)
    put(layers.feed, "late", [("c", "2024-01-09T00:00:00"), ("d", "2024-01-13T01:00:00")])
    for stage in (ingest.run_bronze, ingest.run_silver, ingest.run_quarantine)[:stages]:
        stage(spark, layers)
    ingest.run_update(spark, layers)
    assert ids(ingest.read_silver(spark, layers)) == ["a", "b", "d"]
    assert ids(ingest.read_quarantine(spark, layers)) == ["c"]


def test_an_id_that_comes_again_after_its_state_is_gone(spark, layers):
    days = [("a", "2024-01-10"), ("b", "2024-01-13"), ("d", "2024-01-16"), ("a", "2024-01-20"), ("e", "2024-01-20"), ("a", "2024-01-24")]
    for nth, (key, day) in enumerate(days):
        put(layers.feed, str(nth), [(key, f"{day}T00:00:00")])
        ingest.run_update(spark, layers)
    assert ids(ingest.read_silver(spark, layers)) == ["a", "b", "d", "e"]
    assert ingest.read_quarantine(spark, layers).isEmpty()


def test_a_repeated_batch_replaces_its_own_rows(spark, layers):
    put(layers.feed, "1", [("a", "2024-01-10T00:00:00"), ("b", "2024-01-10T00:00:00")])
    ingest.run_update(spark, layers)
    silver = ingest.finished(spark, layers.silver)
    again = spark.createDataFrame([r.asDict() for r in ingest.read_silver(spark, layers).collect()], ingest.SILVER_SCHEMA)
    ingest._append_silver(spark, layers, again, "00000000", "00000000")
    assert ingest.finished(spark, layers.silver) == silver and ids(ingest.read_silver(spark, layers)) == ["a", "b"]


def test_late_day_merged_once(spark, layers):
    put(layers.feed, "1", [("a", "2024-01-13T00:00:00")])
    ingest.run_update(spark, layers)
    put(layers.feed, "2", [("x", "2024-01-09T00:00:00"), ("x", "2024-01-09T05:00:00"), ("y", "2024-01-08T00:00:00"), ("a", "2024-01-09T00:00:00")])
    ingest.run_update(spark, layers)
    assert ids(ingest.read_quarantine(spark, layers)) == ["x", "x", "y"]
    assert ingest.merge_late(spark, layers, ["2024-01-09"]) and ingest.merge_late(spark, layers, ["2024-01-09"]) is None
    assert ids(ingest.read_silver(spark, layers)) == ["a", "x"] and ids(ingest.read_quarantine(spark, layers)) == ["y"]
    # The stream goes on, and knows the merged ids.
    put(layers.feed, "3", [("x", "2024-01-13T02:00:00"), ("z", "2024-01-13T03:00:00")])
    ingest.run_update(spark, layers)
    assert ids(ingest.read_silver(spark, layers)) == ["a", "x", "z"]


def test_counts_of_many_batches_are_all_kept(spark, layers):
    """Each batch stores its own counts, however many a run has."""
    for nth in range(4):
        put(layers.feed, str(nth), [(f"{nth}", "2024-01-10T00:00:00"), (None, "2024-01-10T00:00:00")])
        ingest.run_update(spark, layers)
    counts = {r["rule"]: (r["n"], r["ok"]) for r in ingest.read_rule_counts(spark, layers).groupBy("rule").agg(F.sum("checked").alias("n"), F.sum("passed").alias("ok")).collect()}
    assert counts["valid_transaction_id"] == (8, 4) and counts["valid_amount"] == (8, 8)


def test_filters_against_plain_sets(spark, tmp_path):
    day = lambda i: dt.date(2024, 1, 1 + i % 3)
    frames = [spark.createDataFrame([(f"id{i}", day(i)) for i in range(a, b)], "id string, date date") for a, b in ((0, 400), (400, 450), (450, 3000))]
    folders = []
    for nth, frame in enumerate(frames):
        id_filters(frame, "id", "date").write.parquet(f"{tmp_path}/{nth}")
        folders.append(f"{tmp_path}/{nth}")
    table = frames[0].unionByName(frames[1]).unionByName(frames[2])
    new = spark.createDataFrame([(f"id{i}", dt.date(2024, 2, 1)) for i in range(2900, 3200)] + [("id7", dt.date(2024, 2, 2))], "id string, date date")
    assert sorted(r["id"] for r in unseen(new, "id", "date", table, folders).collect()) == sorted(f"id{i}" for i in range(3000, 3200))
    assert unseen(new, "id", "date", table.limit(0), []).count() == 301


def test_a_batch_without_rows_reads_no_filter(spark, layers):
    none = spark.createDataFrame([], ingest.SILVER_SCHEMA)
    assert unseen(none, "transaction_id", "event_date", none, [f"{layers.root}/no such folder"]).isEmpty()


def test_a_commit_of_the_state_uploads_changes_only(spark, layers):
    put(layers.feed, "1", [("a", "2024-01-10T00:00:00")])
    ingest.run_update(spark, layers)
    state = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{layers.checkpoint('silver')}/state").select("path")
    assert not state.where("path LIKE '%.changelog'").isEmpty()
