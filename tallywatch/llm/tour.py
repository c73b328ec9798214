"""Prefix sums over a linked list by distributed list ranking.

The list is given by rows ``id, next`` with weights. Each round contracts runs of it to
one element. First by place: elements are dealt by ranges of ``place`` to tasks of at
most ``TASK`` elements on average, and each task walks the links that stay inside it.
If a round by place leaves more than half, the next is by coins: an element that draws
heads takes over its successor if that draws tails, a quarter on average, wherever both
are. When at most ``LAST`` elements are left, one task walks them. The sums before each
element are then handed back down, round by round. The work is in proportion to the list.

Defined results: an empty list gives no rows; an element without successor has a null
``next``; the list must be one, without cycles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.session import written

#: Elements of one task on average, and of a list that is walked by one task.
TASK, LAST = 200_000, 20_000

RUN = pa.schema([("id", pa.binary()), ("head", pa.binary()), ("before", pa.list_(pa.int64())), ("tail", pa.bool_()), ("next", pa.binary()), ("total", pa.list_(pa.int64())), ("place", pa.int64()), ("spot", pa.int64())])
RUN_DDL = "id binary, head binary, before array<long>, tail boolean, next binary, total array<long>, place long, spot long"


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs inside one task: the head of each element, the sums before it in the run, and the run at its tail."""
    ids, links, sums, places, spots = [], [], [], [], []
    for batch in batches:
        for into, name in ((ids, "id"), (links, "next"), (sums, "sums"), (places, "place"), (spots, "spot")):
            into += batch.column(name).to_pylist()
    index = {key: i for i, key in enumerate(ids)}
    follows = {index[key] for key in links if key in index}
    out = []
    for first in range(len(ids)):
        if first in follows:
            continue
        before, at = [0] * len(sums[first]), first
        while at is not None:
            after = [a + b for a, b in zip(before, sums[at], strict=True)]
            to = index.get(links[at])
            tail = to is None
            out.append((ids[at], ids[first], before, tail, links[at] if tail else None, after if tail else None, places[first], spots[first]))
            before, at = after, to
        if len(out) > 20_000:
            yield batch_of(out)
            out = []
    yield batch_of(out)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(RUN)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RUN, strict=True)], schema=RUN)


def by_place(elements: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """``id, head, before`` of each element, and the list of runs."""
    dealt = elements.repartitionByRange(tasks, "place", "spot", "id") if tasks > 1 else elements.coalesce(1)
    runs = written(dealt.mapInArrow(walked, RUN_DDL), "tour-runs")
    left = runs.filter("tail").select(F.col("head").alias("id"), "next", F.col("total").alias("sums"), "place", "spot")
    return runs.select("id", "head", "before"), left


def by_coins(elements: DataFrame, nth: int) -> tuple[DataFrame, DataFrame]:
    """The same with runs of one or two elements."""
    heads = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(nth)), F.lit(2)) == 1
    taking = elements.filter(heads("id") & F.col("next").isNotNull() & ~heads("next"))
    taking = taking.select(F.col("id").alias("head"), F.col("next").alias("id"), F.col("sums").alias("before"), F.col("place").alias("head_place"), F.col("spot").alias("head_spot"))
    both = written(elements.join(taking, "id", "left"), "tour-coins")
    zeros = F.transform("sums", lambda _: F.lit(0).cast("long"))
    members = both.select("id", F.coalesce("head", "id").alias("head"), F.coalesce("before", zeros).alias("before"))
    # A pair goes on where its second element did; an element that took none goes on as it is.
    took = F.col("head").isNotNull()
    pair_sums = F.zip_with("sums", "before", lambda a, b: a + b)
    seconds = both.filter(took).select(F.col("head").alias("id"), "next", pair_sums.alias("sums"), F.col("head_place").alias("place"), F.col("head_spot").alias("spot"))
    alone = both.filter(~took).select("id", "next", "sums", "place", "spot").join(seconds.select("id"), "id", "left_anti")
    return members, written(alone.unionByName(seconds), "tour-left")


def sums_before(elements: DataFrame) -> DataFrame:
    """``id, before``: the sums of all elements before each one, from ``id, next, sums, place, spot``."""
    rounds, n, places_help, nth = [], elements.count(), True, 0
    while n > LAST:
        if places_help:
            members, left = by_place(elements, n // TASK + 2)
        else:
            members, left = by_coins(elements, nth)
        rounds.append(members)
        now = left.count()
        places_help, n, nth, elements = now <= n / 2 if places_help else False, now, nth + 1, left
    members, _ = by_place(elements, 1)
    known = members.select("id", "before")
    for members in reversed(rounds):
        offsets = known.select(F.col("id").alias("head"), F.col("before").alias("offset"))
        added = F.zip_with("before", "offset", lambda a, b: a + b)
        known = written(members.join(offsets, "head").select("id", added.alias("before")), "tour-sums")
    return known
