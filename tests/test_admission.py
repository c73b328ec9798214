"""A backlog taken by event date."""

import datetime as dt
from dataclasses import replace

import pytest
from test_verdict import put

from tallywatch.config import DEFAULTS
from tallywatch.session import new_folder
from tallywatch.sources.admission import Group, feed_days, groups
from tallywatch.streaming import ingest

DAYS = [dt.date(2024, 1, d) for d in range(1, 8)]
ONE_DAY = replace(DEFAULTS, admitted_bytes=1)


@pytest.fixture()
def layers(spark):
    """Seven days in the wrong order of file times, half in folders and half as files; the first id of a day comes again the next."""
    layers = ingest.Layers(new_folder(spark, "backlog"))
    for nth, day in enumerate(DAYS):
        rows = [(f"{nth}-{i}", f"{day}T0{i}:00:00") for i in range(4)] + [(f"{nth - 1}-0", f"{day}T05:00:00")] * (nth > 0)
        folder, name = (f"{layers.feed}/feed_date={day}", "part") if nth % 2 else (layers.feed, f"transactions_{day}")
        put(folder, name, rows, age_days=nth + 1)
    return layers


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def watched(monkeypatch):
    """State rows and input rows of every clean run."""
    seen, run = [], ingest.run_silver

    def run_silver(spark, layers, settings):
        query = run(spark, layers, settings)
        state = query.lastProgress["stateOperators"]  # none if there was no new row
        seen.append((state[0]["numRowsTotal"] if state else 0, sum(p["numInputRows"] for p in query.recentProgress)))
        return query

    monkeypatch.setattr(ingest, "run_silver", run_silver)
    return seen


def test_days_are_listed(spark, layers):
    put(layers.feed, "undated", [("u", "2024-01-10T00:00:00")])
    rows = {r["day"]: r["files"] for r in feed_days(spark, layers.feed).collect()}
    assert rows == {None: 1} | {day: 1 for day in DAYS}


def test_groups():
    sizes = {day: 10 for day in reversed(DAYS[:6])} | {DAYS[6]: 99, dt.date(2024, 1, 8): 1}
    assert [g.days for g in groups(sizes, [], 30)] == [tuple(DAYS[:3]), tuple(DAYS[3:6]), (DAYS[6],), None]
    assert [g.days for g in groups(sizes, DAYS[:5], 30)] == [(DAYS[5],), (DAYS[6],), None]
    assert groups(sizes, list(sizes), 30) == groups({}, [], 30) == [Group(None, 0)]
    assert Group((DAYS[0], DAYS[1]), 0).path("f") == "f/{*2024-01-01*,*2024-01-02*}"


def test_backlog_by_day_loses_nothing_and_bounds_the_state(spark, layers, monkeypatch):
    seen = watched(monkeypatch)
    counts = ingest.run_update(spark, layers, ONE_DAY)
    assert counts["rows"] == 34
    assert ids(ingest.read_silver(spark, layers)) == sorted(f"{n}-{i}" for n in range(7) for i in range(4))
    assert ingest.read_quarantine(spark, layers).isEmpty()
    # An id is kept for two days of event time beyond its own, and the watermark lags two days
    # behind the newest event: four days of four new ids, however long the backlog.
    assert len(seen) == 7 and max(state for state, _ in seen) == 4 * 4 and sum(rows for _, rows in seen) == 34
    assert ingest.run_update(spark, layers, ONE_DAY) == {}


def test_a_stop_between_groups(spark, layers, monkeypatch):
    def stop(*_):
        raise KeyboardInterrupt

    real, calls = ingest.run_late, []

    def run_late(*args):
        calls.append(1)
        return real(*args) if len(calls) < 4 else stop()

    monkeypatch.setattr(ingest, "run_late", run_late)
    with pytest.raises(KeyboardInterrupt):
        ingest.run_update(spark, layers, ONE_DAY)
    assert len(ids(ingest.read_silver(spark, layers))) == 16
    monkeypatch.setattr(ingest, "run_late", real)
    seen = watched(monkeypatch)
    ingest.run_update(spark, layers, ONE_DAY)
    assert len(seen) == 4 and len(ids(ingest.read_silver(spark, layers))) == 28
    assert ingest.read_quarantine(spark, layers).isEmpty()


def test_files_without_a_day_and_of_finished_days_are_taken(spark, layers):
    ingest.run_update(spark, layers)
    put(layers.feed, "undated", [("u", "2024-01-10T00:00:00")])
    put(layers.feed, "transactions_2024-01-02_again", [("v", "2024-01-10T00:00:00"), ("w", "2024-01-02T00:00:00")])
    put(layers.feed, "transactions_2024-01-11", [("x", "2024-01-11T00:00:00")])
    put(layers.feed, "transactions_2024-01-12", [("y", "2024-01-12T00:00:00")])
    ingest.run_update(spark, layers, ONE_DAY)
    assert {"u", "v", "x", "y"} <= set(ids(ingest.read_silver(spark, layers)))
    assert ids(ingest.read_quarantine(spark, layers)) == ["w"]
