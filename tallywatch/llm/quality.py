"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams are compared: one of the target text
(documents labelled good), one of all raw documents. A document's log importance
weight is the sum of the log ratios of its n-grams. Gumbel noise, a function of the
document itself, is added, and the ``k`` documents with the largest keys are kept:
a sample without replacement in proportion to the weights. ``k`` is the number of
documents whose weight lies above the level that best separates the labelled ones.

The target model is fitted on at most ``TARGET_DOCS`` labelled documents, the level
on at most ``LEVEL_DOCS`` others; raw counts, ``k`` and selection cover all documents.

N-grams are hashed words and marks, pairs of neighbours, and a pair of equal
neighbours as a feature of its own.

Defined results: a null or empty text has weight 0; a null id is treated as any
other value; rows that agree in id and text share their noise and their decision;
labels with null or contradicting values are left out; without labels of both
kinds every document is kept. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallywatch.llm.common import row_key
from tallywatch.session import written

BUCKETS = 1 << 14
TARGET_DOCS = 20_000
LEVEL_DOCS = 20_000
SMOOTHING = 1.0
TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+")
REPEAT = 0
PIECE = 1 << 16


def feature_counts(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of a text, repeats included."""
    data = (text or "").encode()
    tokens = TOKEN.findall(data)
    if not tokens:
        return np.zeros(0, np.int64)
    ids = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    pairs = (ids[:-1] * np.uint64(0x9E3779B1) + ids[1:]) >> np.uint64(7)
    size = np.uint64(BUCKETS - 1)
    return np.concatenate([ids % size + 1, np.where(ids[:-1] == ids[1:], REPEAT, pairs % size + 1)]).astype(np.int64)


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """N-gram counts of all texts of ``docs``: a table of ``BUCKETS`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += np.bincount(feature_counts(text.as_py()), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = np.zeros(BUCKETS)
    for bucket, n in docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def weighed(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Adds ``log_weight`` and ``gumbel`` (standard Gumbel noise from ``key``)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [float(shared.value[feature_counts(t.as_py())].sum()) for t in batch.column("text")]
            uniform = np.array([(int(k[:13], 16) + 0.5) / 16**13 for k in batch.column("key").to_pylist()])
            batch = batch.append_column("log_weight", pa.array(weights, pa.float64()))
            yield batch.append_column("gumbel", pa.array(-np.log(-np.log(uniform)) if len(uniform) else [], pa.float64()))

    schema = StructType([*docs.schema.fields, StructField("log_weight", DoubleType()), StructField("gumbel", DoubleType())])
    return docs.mapInArrow(run, schema)


def sortable(value: float) -> int:
    """Order-preserving integer of a double."""
    bits = struct.unpack(">q", struct.pack(">d", value + 0.0))[0]
    return bits if bits >= 0 else bits ^ 0x7FFF_FFFF_FFFF_FFFF


def kth_largest(values: DataFrame, k: int) -> float | None:
    """The k-th largest ``value``, exactly, by counting ever finer ranges: 2,048 counts a round reach the driver."""
    low, high = (values.agg(F.min("value"), F.max("value")).first()[i] for i in (0, 1))
    if low is None or k <= 0:
        return None
    above = 0
    while low < high:
        step = (high - low) / 2048
        bin_of = F.least(F.floor((F.col("value") - F.lit(low)) / F.lit(step)), F.lit(2047)) if step > 0 else F.lit(0)
        inside = values.filter((F.col("value") >= low) & (F.col("value") <= high))
        bins = inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        for row in sorted(bins, key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
        if len(bins) == 1 and step <= 0:
            break
    return high


def clear_labels(labels: DataFrame, name: str) -> DataFrame:
    """``doc_id`` and one agreed value, 0 or 1."""
    known = labels.filter(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return known.agg(F.min(name).alias("label"), F.max(name).alias("most")).filter("label = most").select("doc_id", "label")


def best_level(scores: list[tuple[float, int]]) -> float:
    """The middle of the gap between weights at which fewest labelled documents are on the wrong side."""
    ordered = sorted(scores)
    wrong = best = sum(1 for _, label in ordered if label == 0)
    level, k = ordered[0][0] - 1.0, 0
    while k < len(ordered):
        value = ordered[k][0]
        while k < len(ordered) and ordered[k][0] == value:
            wrong += 1 if ordered[k][1] == 1 else -1
            k += 1
        if wrong < best and k < len(ordered):
            best, level = wrong, (value + ordered[k][0]) / 2
    return level


def fit(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Log ratios by bucket, and the level on the labelled documents' weights."""
    named = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    turn = F.crc32(F.col("doc_id").cast("string"))
    labelled = clear_labels(labels, "quality").withColumn("turn", turn)
    target = labelled.filter("label = 1 and turn % 2 = 0").orderBy("turn", "doc_id").limit(TARGET_DOCS)
    others = labelled.filter("turn % 2 = 1").orderBy("turn", "doc_id").limit(LEVEL_DOCS)
    chosen = target.unionByName(others).select("doc_id", "label", "turn")
    # at most TARGET_DOCS + LEVEL_DOCS rows of three numbers
    sample = written(named.join(F.broadcast(chosen), "doc_id"), "quality-labelled")
    raw = bucket_counts(named) + SMOOTHING
    good = bucket_counts(sample.filter("turn % 2 = 0")) + SMOOTHING
    ratio = np.log(good / good.sum()) - np.log(raw / raw.sum())
    keyed = sample.filter("turn % 2 = 1").withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    scores = [tuple(r) for r in weighed(keyed, ratio).select("log_weight", "label").collect()]
    if len({label for _, label in scores}) < 2 or good.sum() <= BUCKETS * SMOOTHING:
        return np.zeros(BUCKETS), -1.0
    return ratio, best_level(scores)


def decide(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray, float | None]:
    """Weights of all documents, the log ratios and the key from which documents are kept."""
    ratio, level = fit(documents, labels)
    keyed = documents.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    weights = written(weighed(keyed, ratio).select("doc_id", "log_weight", (F.col("log_weight") + F.col("gumbel")).alias("value")), "quality-weights")
    wanted = weights.filter(F.col("log_weight") > level).count()
    return weights, ratio, kth_largest(weights, wanted)


def resampled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, log_weight, key, kept``."""
    weights, _, least = decide(documents, labels)
    kept = F.col("value") >= least if least is not None else F.lit(False)
    return weights.select("doc_id", "log_weight", F.col("value").alias("key"), kept.alias("kept"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    _, ratio, least = decide(documents, labels)
    own = documents.select("text", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct("*").alias("row"))
    again = weighed(own, ratio)
    kept = F.col("log_weight") + F.col("gumbel") >= least if least is not None else F.lit(False)
    return again.filter(kept).select("row.*")
