"""Substring dedup: passages of repeated words, hashed, grouped globally, the earliest kept.

A repeated passage is a run of ``min_words`` words or more (A-Z lower-cased, white space
folded) that stands in two places. Its units are the windows of ``min_words`` words inside
it, so lines, paragraphs and passages in running text are found alike and to the word.
Hashing every window of every text would cost a row for each word. So first each window
names one anchor, the last of its runs of ``ANCHOR`` words with the least hash; equal
windows name equal anchors, about one for twenty words. Only windows whose anchor
occurs more than once are grouped. Of all windows with one digest the earliest by
``(doc_id, place)`` stays and the others go; a window that overlaps the earliest in the
same text is not a copy of it. A text's removed windows are joined to spans of its own
characters, each up to the next word that stays.

Of texts that are equal as a whole only the row with the least ``doc_id`` is looked into;
the others lose all their words, if they have ``min_words``. So a large group of copies
costs one aggregation.

Defined results: a null text stays null and has no words; texts of fewer words stay as they
are; a null ``doc_id`` ranks last; of rows that repeat id and text one keeps its words;
texts of any length are taken whole; an empty table gives an empty result. Other columns
are kept by ``without_repeats``, whatever their names, and ignored by ``repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import text_key
from tallywatch.session import written

MIN_WORDS = 50
#: Words of an anchor.
ANCHOR = 12
#: Windows whose anchors are sought at a time, which bounds memory in very long texts.
STEP = 100_000
WORD = re.compile(r"[^ \t\n\r\f\v]+")
SPANS = "array<struct<begin:int,end:int>>"
#: Odd multipliers of the two halves of a digest, and their inverses modulo 2^64.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def powers_of(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def run_digests(words: np.ndarray, size: int) -> np.ndarray:
    """Digests of all runs of ``size`` words, 16 bytes each as two numbers: equal runs have equal ones wherever they stand."""
    n = len(words)
    out = np.empty((n - size + 1, 2), np.uint64)
    for half, factor in enumerate(FACTORS):
        mixed = words if half == 0 else (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = mixed ^ (mixed >> np.uint64(32))
        powers = powers_of(factor, n)
        back = powers_of(pow(factor, -1, 1 << 64), n - size + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers)])
        out[:, half] = (sums[size:] - sums[:-size]) * back
    out[:, 0] ^= out[:, 0] >> np.uint64(31)
    return out


def anchors(runs: np.ndarray, windows: int, span: int) -> np.ndarray:
    """For each window the place of its anchor: of the ``span`` runs in it the last with the least hash."""
    order = runs[:, 0] * np.uint64(0x94D049BB133111EB)
    out = np.empty(windows, np.int64)
    for at in range(0, windows, STEP):
        stop = min(at + STEP, windows)
        view = np.lib.stride_tricks.sliding_window_view(order[at : stop + span - 1], span)
        out[at:stop] = np.arange(at, stop) + span - 1 - np.argmin(view[:, ::-1], axis=1)
    return out


def as_binary(digests: np.ndarray) -> pa.Array:
    ends = pa.py_buffer(np.arange(0, 16 * len(digests) + 1, 16, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(digests), [None, ends, pa.py_buffer(np.ascontiguousarray(digests).tobytes())])


def table_of(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Digests and places of several texts, with the other columns repeated."""
    digests = as_binary(np.concatenate([f[0] for f in found]) if found else np.empty((0, 2), np.uint64))
    places = pa.array(np.concatenate([f[1] for f in found]).astype(np.int32) if found else [], pa.int32())
    sizes = [len(f[1]) for f in found]
    rows = pa.array(np.repeat(np.arange(len(found)), sizes))
    others = [pa.array([f[2 + i] for f in found], pa.int64()).take(rows) for i in range(2 if "rank" in names else 1)]
    if "again" in names:
        others.append(pa.array(np.concatenate([f[3] for f in found]) if found else [], pa.bool_()))
    return pa.RecordBatch.from_arrays([digests, places, *others], names=names)


def anchor_table(texts: DataFrame, min_words: int) -> DataFrame:
    """``digest, place, brief, again`` of the anchors of ``brief, text``: one row for each text and digest, ``again`` if it has several places."""
    size = min(ANCHOR, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for brief, text in zip(batch.column("brief").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = word_hashes(text or "")
                if len(words) >= min_words:
                    runs = run_digests(words, size)
                    places = np.unique(anchors(runs, len(words) - min_words + 1, min_words - size + 1))
                    _, first, times = np.unique(runs[places, 0], return_index=True, return_counts=True)
                    found.append((runs[places[first]], places[first], brief, times > 1))
            yield table_of(found, ["digest", "place", "brief", "again"])

    return texts.mapInArrow(run, "digest binary, place int, brief long, again boolean")


def window_table(texts: DataFrame, min_words: int) -> DataFrame:
    """``digest, place, rank, brief`` of every window with an anchor as at one of the places ``hits``."""
    size = min(ANCHOR, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for brief, rank, text, hits in zip(*(batch.column(c).to_pylist() for c in ("brief", "rank", "text", "hits")), strict=True):
                words = word_hashes(text)
                if len(words) >= min_words:
                    runs, at = run_digests(words, size), np.array(hits)
                    named = anchors(runs, len(words) - min_words + 1, min_words - size + 1)
                    places = np.flatnonzero(np.isin(runs[named, 0], runs[at[at < len(runs)], 0]))
                    found.append((run_digests(words, min_words)[places], places, rank, brief))
            yield table_of(found, ["digest", "place", "rank", "brief"])

    return texts.select("brief", "rank", "text", "hits").mapInArrow(run, "digest binary, place int, rank long, brief long")


def removed_windows(texts: DataFrame, leaders: DataFrame, min_words: int) -> DataFrame:
    """``brief, rank, places``: the first words of the windows to remove from leading texts.

    ``brief`` is a short digest of the text: if two texts had the same, more windows would be looked into,
    and with the same id too they would count as one text.
    """
    marked = written(anchor_table(texts.select("brief", "text"), min_words), "repeat-anchors")
    # Digests in more than one place.
    again = marked.groupBy("digest").agg(F.min("brief").alias("low"), F.max("brief").alias("high"), F.max("again").alias("again")).filter("low != high or again").select("digest")
    hits = marked.join(written(again, "repeat-again"), "digest", "left_semi").groupBy("brief").agg(F.collect_set("place").alias("hits"))
    own = leaders.select("brief", F.col("lead").alias("rank")).join(hits, "brief")
    looked = texts.join(own, ["brief", "rank"])
    windows = written(window_table(looked, min_words), "repeat-windows")
    order = F.struct("rank", "brief", "place")
    first = windows.groupBy("digest").agg(F.min(order).alias("first"), F.max(order).alias("last")).filter("first != last")
    first = written(first.select("digest", F.col("first.rank").alias("first_rank"), F.col("first.brief").alias("first_brief"), F.col("first.place").alias("first_place")), "repeat-first")
    same_text = (F.col("rank") == F.col("first_rank")) & (F.col("brief") == F.col("first_brief"))
    gone = windows.join(first, "digest").filter(~(same_text & (F.col("place") < F.col("first_place") + min_words)))
    return gone.groupBy("brief", "rank").agg(F.collect_set("place").alias("places"))


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (the own columns), ``text`` (what is left) and ``spans`` (what was removed) of every document."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    brief = F.expr("xxhash64(coalesce(text, ''), length(text))")
    texts = documents.select(brief.alias("brief"), rank.alias("rank"), "text")
    whole = texts.select("brief", "rank", text_key(F.col("text")).alias("key"))
    each = whole.groupBy("key", "brief", "rank").agg(F.count("*").alias("rows"))
    lead = F.min(F.struct("rank", "rows")).alias("lead")
    leaders = each.groupBy("key", "brief").agg(lead, F.sum("rows").alias("rows"))
    leaders = written(leaders.select("key", "brief", F.col("lead.rank").alias("lead"), F.col("lead.rows").alias("lead_rows"), "rows"), "repeat-leaders")
    places = removed_windows(texts, leaders, min_words).withColumnRenamed("rank", "lead")
    # Only texts that lose something or have copies; the leaders' places go with their key.
    known = leaders.join(places, ["brief", "lead"], "left").filter("rows > 1 or places is not null").drop("brief")
    own = documents.select(F.struct("*").alias("row"), rank.alias("rank"), text_key(F.col("text")).alias("key")).join(written(known, "repeat-known"), "key", "left")
    copy = F.coalesce((F.col("rows") > 1) & (F.col("rank") != F.col("lead")), F.lit(False))
    told = own.withColumn("copy", copy).withColumn("tied", F.coalesce(F.col("lead_rows") > 1, F.lit(False)) & ~F.col("copy"))
    single = told.filter("not tied").select("row", "places", "copy")
    # Rows that agree in id and text: the first of them leads. The numbers are stored, since a second computation might give others.
    ordered = written(told.filter("tied").select("key", "row", "places").withColumn("nth", F.monotonically_increasing_id()), "repeat-ordered")
    first = ordered.groupBy("key").agg(F.min("nth").alias("first"))
    tied = ordered.join(first, "key").select("row", "places", (F.col("nth") > F.col("first")).alias("copy"))
    return cut(single.unionByName(tied).withColumn("text", F.col("row.text")), min_words)


def spans_of(text: str, places: list[int] | None, copy: bool, min_words: int) -> list[dict[str, int]]:
    """Character spans of removed windows; an end is where the next word begins."""
    words = [m.start() for m in WORD.finditer(text)]
    if copy:
        places = [*range(0, len(words) - min_words + 1, min_words), len(words) - min_words] if len(words) >= min_words else []
    runs: list[list[int]] = []
    for place in sorted(places or ()):
        if runs and place <= runs[-1][1]:
            runs[-1][1] = place + min_words
        else:
            runs.append([place, place + min_words])
    return [{"begin": words[a], "end": words[b] if b < len(words) else len(text)} for a, b in runs]


def cut(rows: DataFrame, min_words: int) -> DataFrame:
    """``row, text, spans`` from ``row, text, places, copy``: the text without its removed windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, places, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "places", "copy")), strict=True):
                spans = spans_of(text, places, copy, min_words) if text and (copy or places) else []
                if spans:
                    pieces, at = [], 0
                    for span in spans:
                        pieces.append(text[at : span["begin"]])
                        at = span["end"]
                    text = "".join([*pieces, text[at:]])
                kept.append(text)
                removed.append(spans)
            kinds = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string()), pa.array(removed, kinds)], names=["row", "text", "spans"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, spans {SPANS}")


def repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc_id, text, spans, n_removed``."""
    left = without_repeats(documents.select("doc_id", "text"), min_words)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"])
    return left.select("row.doc_id", "text", "spans", removed.alias("n_removed"))


def cleaned(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages removed; ``n_chars`` follows the text, other columns stay."""
    left = without_repeats(documents, min_words)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*(new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in documents.columns))
