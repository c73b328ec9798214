"""Incremental runs: feed to Bronze, Bronze to Silver and quarantine.

Every run takes what is new, commits it once, and stops. A lost executor or a
killed run is retried from the checkpoint. Each micro-batch owns a folder of every
table it writes, so a repeated batch replaces its own rows, and readers take only
folders that were finished.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallywatch.config import DEFAULTS, Settings
from tallywatch.functions.rules import HARD_RULES, LATE_EVENT, failed_names, fails, passes
from tallywatch.operators.contract import BRONZE_SCHEMA, CONTRACT, SILVER_COLUMNS, expectation_metrics, typed
from tallywatch.operators.dedup import first_arrivals
from tallywatch.operators.skew import join_small
from tallywatch.session import child_names, written
from tallywatch.sources.admission import Group, feed_days, groups
from tallywatch.sources.feed import stream_bronze, stream_feed
from tallywatch.streaming.uniqueness import id_filters, unseen

#: Begins the names of batches of merged late rows; those of the stream are numbers.
LATE_LABEL = "late-"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Layers:
    """Folders of one set of tables."""

    root: str
    feed_folder: str | None = None

    @property
    def feed(self) -> str:
        return self.feed_folder or f"{self.root}/feed"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def admitted(self) -> str:
        return f"{self.root}/admitted_days"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def silver_ids(self) -> str:
        return f"{self.root}/silver_ids"

    @property
    def newest(self) -> str:
        return f"{self.root}/newest_events"

    @property
    def rejected(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def late(self) -> str:
        return f"{self.root}/quarantine_late"

    @property
    def rule_counts(self) -> str:
        return f"{self.root}/expectation_counts"

    def gold(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


_TYPES = {"timestamp": T.TimestampType(), "double": T.DoubleType(), "int": T.IntegerType()}
SILVER_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES.get(kind, T.StringType())) for name, kind in CONTRACT.items()]
    + [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, _TYPES.get(CONTRACT.get(f.name, ""), f.dataType))
        for f in BRONZE_SCHEMA
    ]
    + [T.StructField("_quarantine_reason", T.StringType())]
)


def finished(spark: SparkSession, path: str, before: str | None = None) -> list[str]:
    """Folders of finished batches, in order; ``before`` leaves out that batch and later ones of its kind."""
    names = sorted(n for n in child_names(spark, path) if n.startswith("batch="))
    if before is not None:
        merged = [n.startswith(f"batch={LATE_LABEL}") for n in (f"batch={before}", *names)]
        names = [n for n, kind in zip(names, merged[1:], strict=True) if kind != merged[0] or n < f"batch={before}"]
    return [f"{path}/{n}" for n in names if "_SUCCESS" in child_names(spark, f"{path}/{n}")]


def _read(spark: SparkSession, path: str, schema: T.StructType, folders: Iterable[str] | None = None) -> DataFrame:
    folders = finished(spark, path) if folders is None else list(folders)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def _label(batch_id: int) -> str:
    return f"{batch_id:08d}"


def _each(df: DataFrame, checkpoint: str, write) -> StreamingQuery:
    query = df.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def run_bronze(spark: SparkSession, layers: Layers, max_files: int | None = None, group: Group | None = None) -> StreamingQuery:
    """Append new files of the feed, or of a group of its days.

    The log of the files taken belongs to the checkpoint, whichever part of the feed a run names.
    """
    path = layers.feed if group is None else group.path(layers.feed)
    writer = stream_feed(spark, path, max_files).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", layers.checkpoint("bronze")).start(layers.bronze)
    query.awaitTermination()
    return query


def clean_stream(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Valid rows, the first arrival of each id.

    Rules come before the watermark, so an invalid first copy does not hide a
    valid later one and rows without a timestamp never reach the state.
    """
    return (
        typed(bronze)
        .where(passes(HARD_RULES))
        .withWatermark("event_ts", f"{settings.watermark_days} days")
        .dropDuplicatesWithinWatermark(["transaction_id"])
        .select(*SILVER_COLUMNS)
    )


def _append_silver(spark: SparkSession, layers: Layers, rows: DataFrame, label: str, before: str | None) -> None:
    """Add rows whose ids Silver does not hold as the batch ``label``.

    The filters of the ids come first and the rows last: a stop between them leaves
    filters that say "perhaps" once too often, never an id that no filter knows.
    """
    silver = finished(spark, layers.silver, before)
    fresh = unseen(
        rows, "transaction_id", "event_date",
        _read(spark, layers.silver, SILVER_SCHEMA, silver),
        [f"{layers.silver_ids}/{folder.rsplit('/', 1)[1]}" for folder in silver],
    )
    id_filters(fresh, "transaction_id", "event_date").write.mode("overwrite").parquet(f"{layers.silver_ids}/batch={label}")
    fresh.write.mode("overwrite").partitionBy("event_date").parquet(f"{layers.silver}/batch={label}")


def run_silver(spark: SparkSession, layers: Layers, settings: Settings = DEFAULTS) -> StreamingQuery:
    """Append new clean rows, partitioned by event date.

    The state of the stream drops copies inside the watermark; ids that come again
    after their state is gone are found by the filters of the stored ids.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A commit uploads what a batch changed, not the files of the whole state.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")

    def append(batch: DataFrame, batch_id: int) -> None:
        label = _label(batch_id)
        _append_silver(spark, layers, written(batch, "silver-batch"), label, label)

    clean = clean_stream(stream_bronze(spark, layers.bronze), settings)
    return _each(clean.withColumn("event_date", F.to_date("event_ts")), layers.checkpoint("silver"), append)


def run_quarantine(spark: SparkSession, layers: Layers) -> list[str]:
    """Keep rejected rows, and the counts per rule of every batch; returns the batches of this run."""
    rows = typed(stream_bronze(spark, layers.bronze))
    done: list[str] = []

    def reject(batch: DataFrame, batch_id: int) -> None:
        label = _label(batch_id)
        rejected = batch.where(fails(HARD_RULES)).withColumn("_quarantine_reason", failed_names(HARD_RULES))
        rejected.write.mode("overwrite").parquet(f"{layers.rejected}/batch={label}")
        counts = expectation_metrics(batch).select(
            "rule", (F.col("passed_rows") + F.col("failed_rows")).alias("checked"), F.col("passed_rows").alias("passed"), F.current_timestamp().alias("run_at")
        )
        counts.coalesce(1).write.mode("overwrite").parquet(f"{layers.rule_counts}/batch={label}")
        done.append(label)

    _each(rows, layers.checkpoint("quarantine"), reject)
    return done


def run_late(spark: SparkSession, layers: Layers, settings: Settings = DEFAULTS) -> StreamingQuery:
    """Keep valid rows that came too late for Silver, unless Silver has their id.

    Run it after ``run_silver``, which has then taken every row it was ever going to
    take of the Bronze files seen here. A valid row that Silver lacks was late. Only
    rows behind the newest event so far by the watermark's delay can be; that moment is
    stored with each batch, so a run that stopped before this stage loses nothing.
    """
    rows = typed(stream_bronze(spark, layers.bronze)).where(passes(HARD_RULES))
    columns = [f.name for f in BRONZE_SCHEMA]
    late = rows.select(*columns).withColumn("_quarantine_reason", F.lit(LATE_EVENT))
    schema = T.StructType([T.StructField("newest", T.TimestampType())])

    def keep_unknown(batch: DataFrame, batch_id: int) -> None:
        label = _label(batch_id)
        batch.agg(F.max("event_ts").alias("newest")).coalesce(1).write.mode("overwrite").parquet(f"{layers.newest}/batch={label}")
        newest = _read(spark, layers.newest, schema, [*finished(spark, layers.newest, label), f"{layers.newest}/batch={label}"])
        reached = newest.agg(F.max("newest")).first()[0]  # one row for each batch
        if reached is None:
            return
        behind = written(batch.where(F.col("event_ts") <= F.lit(reached) - F.expr(f"INTERVAL {settings.watermark_days} DAYS")), "late-batch")
        # ids of these rows that Silver holds: Silver is only scanned if they are few
        known = join_small(
            read_silver(spark, layers).select("transaction_id"),
            behind.select("transaction_id").distinct(),
            "transaction_id",
        )
        missing = behind.join(known, "transaction_id", "left_anti").select(*late.columns)
        missing.write.mode("overwrite").parquet(f"{layers.late}/batch={label}")

    return _each(late, layers.checkpoint("late"), keep_unknown)


def merge_late(spark: SparkSession, layers: Layers, dates: list[str]) -> str | None:
    """Move late rows of some days from quarantine to Silver; returns the batch that holds them, None if there were none.

    The rows become a batch of their own beside those of the stream, whose state and
    watermark stay as they are. Its finished folder is the commit: ``read_late`` leaves out
    what it holds, and repeating the merge finds nothing more.
    """
    day = F.to_date("event_ts")
    rows = read_late(spark, layers).where(day.isin([F.lit(d).cast("date") for d in dates]))
    arrival = [F.col("_ingested_at"), F.col("_source_file"), F.col("amount"), F.col("event_ts")]
    first = first_arrivals(rows, ["transaction_id"], arrival).select(*SILVER_COLUMNS).withColumn("event_date", day)
    stored = written(first, "late-merge")
    if stored.isEmpty():
        return None
    label = f"{LATE_LABEL}{_label(len(_merged(spark, layers)))}"
    _append_silver(spark, layers, stored, label, label)
    return label


def _merged(spark: SparkSession, layers: Layers) -> list[str]:
    return [f for f in finished(spark, layers.silver) if f"/batch={LATE_LABEL}" in f]


def silver_batches(spark: SparkSession, layers: Layers) -> list[str]:
    """Names of the finished batches of clean rows, those of merged late rows included."""
    return [folder.rsplit("/", 1)[1] for folder in finished(spark, layers.silver)]


def read_silver(spark: SparkSession, layers: Layers, batches: list[str] | None = None) -> DataFrame:
    """Clean rows; of all finished batches, or of the given ones."""
    return _read(spark, layers.silver, SILVER_SCHEMA, None if batches is None else [f"{layers.silver}/{b}" for b in batches])


def read_late(spark: SparkSession, layers: Layers) -> DataFrame:
    """Late rows that were not merged into Silver since."""
    late = _read(spark, layers.late, QUARANTINE_SCHEMA)
    merged = _merged(spark, layers)
    if not merged:
        return late
    ids = _read(spark, layers.silver, SILVER_SCHEMA, merged).select("transaction_id")
    return late.join(ids, "transaction_id", "left_anti").select(*QUARANTINE_SCHEMA.names)


def read_quarantine(spark: SparkSession, layers: Layers) -> DataFrame:
    """Rejected and late rows together."""
    return _read(spark, layers.rejected, QUARANTINE_SCHEMA).unionByName(read_late(spark, layers))


RULE_COUNTS = T.StructType([T.StructField("rule", T.StringType()), T.StructField("checked", T.LongType()), T.StructField("passed", T.LongType()), T.StructField("run_at", T.TimestampType())])


def read_rule_counts(spark: SparkSession, layers: Layers, batches: list[str] | None = None) -> DataFrame:
    """Rows checked and passed per rule and batch; of all batches, or of the given ones."""
    folders = None if batches is None else [f"{layers.rule_counts}/batch={label}" for label in batches]
    return _read(spark, layers.rule_counts, RULE_COUNTS, folders)


ADMITTED = T.StructType([T.StructField("day", T.DateType())])


def run_update(spark: SparkSession, layers: Layers, settings: Settings = DEFAULTS) -> dict[str, int]:
    """Ingest what is new and carry it to Silver and quarantine; returns rows and passes per rule of this run.

    A backlog is taken by event date in groups of at most ``admitted_bytes``, or one day.
    A day counts as admitted when all stages have taken its group; after a stop the group
    is named again, and the checkpoints know what of it they have.
    """
    # one row for each day, here and below
    sizes = {r["day"]: r["bytes"] for r in feed_days(spark, layers.feed).where("day IS NOT NULL").collect()}
    admitted = {r["day"] for r in _read(spark, layers.admitted, ADMITTED).collect()}
    batches: list[str] = []
    for group in groups(sizes, admitted, settings.admitted_bytes):
        run_bronze(spark, layers, group=group)
        run_silver(spark, layers, settings)
        batches += run_quarantine(spark, layers)
        run_late(spark, layers, settings)
        new = sorted(set(sizes if group.days is None else group.days) - admitted)
        if new:
            label = _label(len(finished(spark, layers.admitted)))
            spark.createDataFrame([(day,) for day in new], ADMITTED).coalesce(1).write.mode("overwrite").parquet(f"{layers.admitted}/batch={label}")
            admitted.update(new)
    totals = read_rule_counts(spark, layers, batches).groupBy("rule").agg(F.sum("checked").alias("checked"), F.sum("passed").alias("passed"))
    counts = {r["rule"]: r["passed"] for r in totals.collect()}  # one row for each rule
    checked = totals.agg(F.max("checked")).first()[0]
    return {"rows": checked, **counts} if counts else {}
