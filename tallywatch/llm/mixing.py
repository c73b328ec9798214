"""Mixing sources to target weights by a low-discrepancy schedule (native).

Each source's documents, shuffled by a digest of their id, form a stream of
tokens that is cut into equal blocks. Slot ``k`` of the schedule takes the point
``frac((k + 1) / golden ratio)``; mapped through the cumulative weights it names a
source, and its rank among that source's slots names the block. A source whose
stream is used up starts again at its first block, up to twice. A document's
``first_slot`` is that of the first block that holds any of its words: read in this order,
every prefix of the mix has its sources near their shares.

Defined results: a null text has size 0; a null source is a source of its own and
comes last; repeated rows are documents of their own; an empty table gives an
empty result; a document of size 0 is taken 0 times and, like all others of which
nothing is taken, has the first slot -1. Other columns are ignored,
so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import BLANK_WORD
from tallywatch.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_TOKENS = 2048
CELL_DOCS = 4096
CHUNK_SLOTS = 65_536
GRID = 4096
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` to ``sid, target, quota`` and the share ``[low, high)`` of the schedule.

    Sources are filled in the order in which they reach their cap, so one pass of
    running sums finds the level at which the rest share by weight.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    before = everything.orderBy("fill", "sid").rowsBetween(Window.unboundedPreceding, -1)
    named = sizes.withColumn("sid", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    )
    cap = F.col("source_size") * MOST_PASSES
    ranked = (
        named.withColumn("fill", cap / F.col("weight"))
        .withColumn("room", F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", cap * F.col("weights") <= F.col("room") * F.col("weight"))
    )
    level = F.try_divide(F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(everything), F.lit(0)),
        F.sum("weight").over(everything) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(everything), F.lit(0))
    )
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(F.col("weight") * F.col("level"))
    running = everything.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranked.withColumn("level", F.when(~F.min("capped").over(everything), level).otherwise(F.lit(0.0)))
        .withColumn("target", target)
        .withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("high", F.try_divide(F.sum("target").over(running), F.sum("target").over(everything)))
        .withColumn("low", F.coalesce(F.lag("high").over(everything.orderBy("sid")), F.lit(0.0)))
        .select("sid", "source", "source_size", "target", "quota", "low", "high")
    )


def token_stream(docs: DataFrame, cells: int) -> DataFrame:
    """Adds ``start``, a document's first position in the shuffled stream of its source.

    The stream of a source is cut into cells of about ``CELL_DOCS`` documents, so
    the running sum of no source is left to one task.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    point = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long")
    cells_before = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("sid", "cell").orderBy("shuffle", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("shuffle", order).withColumn("cell", F.shiftright(point * cells, 32))
    offsets = placed.groupBy("sid", "cell").agg(F.sum("size").alias("cell_size")).select(
        "sid", "cell", F.coalesce(F.sum("cell_size").over(cells_before), F.lit(0)).alias("cell_start")
    )
    return placed.join(offsets, ["sid", "cell"]).withColumn(
        "start", F.col("cell_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """``sid, block, slot, first, last``: which positions of a source's stream each slot takes.

    Slots beyond a source's quota are left out; the few that the sequence still owes
    a source at its end follow after the others.
    """
    spark = targets.sparkSession
    cells = targets.filter("high > low").withColumn(
        "grid", F.explode(F.sequence(F.floor(F.col("low") * GRID), F.floor(F.col("high") * GRID)))
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") + 1) * F.lit(GOLDEN) % 1).alias("point"))
    named = (
        points.withColumn("grid", F.floor(F.col("point") * GRID))
        .join(cells.select("grid", "sid", "low", "high"), "grid")
        .filter("point >= low and point < high")
        .select("sid", "slot", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"))
    )
    chunks_before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = named.groupBy("sid", "chunk").agg(F.count("*").alias("chunk_slots"))
    starts = chunks.select("sid", "chunk", F.coalesce(F.sum("chunk_slots").over(chunks_before), F.lit(0)).alias("chunk_start"))
    ranked = named.join(starts, ["sid", "chunk"]).select(
        "sid", "slot", (F.col("chunk_start") + F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1).alias("block")
    )
    had = chunks.groupBy("sid").agg(F.sum("chunk_slots").alias("had"))
    blocks = F.ceil(F.col("quota") / BLOCK_TOKENS)
    owed = (
        targets.join(had, "sid", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .filter(F.col("had") < blocks)
        .select("sid", F.lit(slots).cast("long").alias("slot"), F.explode(F.sequence(F.col("had"), blocks - 1)).alias("block"))
    )
    first = F.col("block") * BLOCK_TOKENS
    return (
        ranked.unionByName(owed)
        .join(targets.select("sid", "quota"), "sid")
        .filter(first < F.col("quota"))
        .select("sid", "block", "slot", first.alias("first"), F.least(first + BLOCK_TOKENS, "quota").alias("last"))
    )


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, first_slot`` for every document."""
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = written(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))),
        "mix-targets",
    )
    total = targets.agg(F.sum("quota")).first()[0] or 0
    cells = max(1, sized.count() // CELL_DOCS)
    known = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.doc_id", "d.source", "d.size", "t.sid", "t.source_size", "t.target", "t.quota"
    )
    stream = written(token_stream(known, cells).drop("shuffle", "cell", "cell_start"), "mix-stream")
    slots = schedule(targets, -(-total // BLOCK_TOKENS))
    begin = F.col("start") + F.col("source_size") * F.col("pass")
    end = F.least(begin + F.col("size"), "quota")
    pieces = (
        stream.filter("size > 0")
        .select("*", F.explode(F.array(*(F.lit(k).cast("long") for k in range(MOST_PASSES)))).alias("pass"))
        .withColumns({"begin": begin, "end": end})
        .filter("begin < end")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / BLOCK_TOKENS), F.floor((F.col("end") - 1) / BLOCK_TOKENS))))
    )
    took = (
        pieces.join(slots, ["sid", "block"])
        .groupBy("sid", "start")
        .agg(F.sum(F.least("end", "last") - F.greatest("begin", "first")).alias("taken"), F.min("slot").alias("first_slot"))
    )
    result = ["doc_id", "source", "size", "source_size", "target"]
    # A document of some size is alone at its position; those of size 0 are never taken.
    return (
        stream.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
        .join(took.withColumnRenamed("start", "at"), ["sid", "at"], "left")
        .select(*result, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("first_slot", F.lit(-1)).cast("long").alias("first_slot"))
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((sid - 1) % 3 + 1)::BIGINT]::BIGINT AS weight FROM s
), r AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER o, 0) AS room,
    sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weights
  FROM w WINDOW o AS (ORDER BY 2 * source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, 2 * source_size * weights <= room * weight AS capped FROM r
), t AS (
  SELECT source, sid, source_size, CASE WHEN capped THEN (2 * source_size)::DOUBLE
    ELSE weight * ((1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (capped) OVER (), 0))
      / (sum(weight) OVER () - coalesce(sum(weight) FILTER (capped) OVER (), 0))) END AS target
  FROM c
), p AS (
  SELECT d.doc_id, d.size, t.sid, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
    coalesce(sum(d.size) OVER (PARTITION BY t.sid ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT ceil(sum(floor(target + 0.5)) / 2048)::BIGINT AS slots FROM t
), h AS (
  SELECT sid, sum(target) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS high FROM t
), b AS (
  SELECT sid, coalesce(lag(high) OVER (ORDER BY sid), 0) AS low, high FROM h
), k AS (
  SELECT slot, (slot + 1) * 0.6180339887498949::DOUBLE % 1 AS point FROM (SELECT unnest(generate_series(0, slots - 1)) AS slot FROM n WHERE slots > 0)
), q AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block FROM k JOIN b ON point >= low AND point < high
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(begin + size, quota) - begin) + greatest(0, least(begin + size + source_size, quota) - begin - source_size))::BIGINT AS taken,
  CASE WHEN size > 0 AND begin < quota THEN coalesce(slot, (SELECT slots FROM n)) ELSE -1 END::BIGINT AS first_slot
FROM p LEFT JOIN q ON p.sid = q.sid AND q.block = p.begin // 2048
"""
