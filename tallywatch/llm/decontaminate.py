"""Benchmark decontamination by a distributed positional inverted index (native).

Postings ``(text, term, position)`` of the training tokens are stored for the
rarest terms of every benchmark window. Lists shifted by the term's offset in the
window are intersected, from the rarest term on; what is left is compared with the
whole window in the text, so the matches are exact. ``proximity`` finds windows
whose two rarest terms stand within some distance of each other.

Defined results: a null text has no words; a null item id counts as the empty
string; repeated rows keep their own result rows; without benchmark words no
document is contaminated. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import lower_ascii, text_key
from tallywatch.session import written

WINDOW_WORDS = 10
RAREST = 2
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), GAP), ""), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``win, items``: distinct windows of words and the items that hold them."""
    spoken = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("said"))
    length = F.size("said")
    starts = F.sequence(F.lit(1), F.greatest(length - WINDOW_WORDS + 1, F.lit(1)))
    return (
        spoken.filter(length > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("said", i, F.lit(WINDOW_WORDS)))).alias("win"))
        .groupBy("win")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("win_id", F.xxhash64("win"))
    )


def tokens(docs: DataFrame) -> DataFrame:
    return docs.select("text_id", F.posexplode(words(F.col("text"))).alias("position", "term"))


def rarest_terms(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """``win, term, offset, place``: the rarest terms of each window that can occur, by count in all documents."""
    placed = windows.select("win", F.posexplode("win").alias("offset", "term"))
    counts = tokens(docs).join(written(placed.select("term").distinct(), "leak-terms"), "term").groupBy("term").count()
    ranked = (
        placed.join(counts, "term", "left")
        .groupBy("win")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "term", "offset"))).alias("by_count"))
        .filter(F.col("by_count")[0]["count"] > 0)
    )
    rare = F.slice("by_count", 1, RAREST)
    return ranked.select("win", F.posexplode(rare).alias("place", "rare")).select("win", "place", "rare.term", "rare.offset")


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``text_id, hits``: for each text with occurrences their start, length and items."""
    rare = written(rarest_terms(windows, docs).join(windows, "win"), "leak-rare")
    postings = written(tokens(docs).join(written(rare.select("term").distinct(), "leak-rare-terms"), "term"), "leak-postings")
    shifted = postings.join(rare, "term").select("text_id", (F.col("position") - F.col("offset")).alias("start"), "win_id", "place")
    together = (
        shifted.filter("start >= 0")
        .groupBy("text_id", "start", "win_id")
        .agg(F.bit_or(F.col("place") + 1).alias("places"))
    )
    candidates = (
        together.join(rare.filter("place = 0").select("win_id", "win", "items"), "win_id")
        .filter(F.bit_count("places") == F.least(F.size("win"), F.lit(RAREST)))
        .groupBy("text_id")
        .agg(F.collect_list(F.struct("start", "win", "items")).alias("candidates"))
    )
    exact = F.filter("candidates", lambda c: F.slice("said", c["start"] + 1, F.size(c["win"])) == c["win"])
    found = (
        docs.join(written(candidates, "leak-candidates"), "text_id")
        .withColumn("said", words(F.col("text")))
        .select("text_id", F.transform(exact, lambda c: F.struct(c["start"], F.size(c["win"]).alias("length"), c["items"])).alias("hits"))
        .filter(F.size("hits") > 0)
    )
    # Copies of a text have the same hits.
    return found.groupBy("text_id").agg(F.any_value("hits").alias("hits"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    docs = documents.select("doc_id", "text", text_key(F.col("text")).alias("text_id"))
    windows = written(benchmark_windows(benchmark), "leak-windows")
    hits = written(occurrences(docs.select("text_id", "text"), windows), "leak-hits").select(
        "text_id",
        F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("items"),
    )
    n_words = F.coalesce(F.regexp_count("text", F.lit(RAW_WORD)), F.lit(0)).cast("long")
    return (
        docs.select("doc_id", "text_id", n_words.alias("n_words"))
        .join(hits, "text_id", "left")
        .select(
            "doc_id",
            "text_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def proximity(documents: DataFrame, benchmark: DataFrame, distance: int) -> DataFrame:
    """``text_id, win_id, start``: places where a window's rarest terms stand within ``distance`` words of each other."""
    docs = documents.select("text", text_key(F.col("text")).alias("text_id"))
    windows = written(benchmark_windows(benchmark), "near-windows")
    rare = written(rarest_terms(windows, docs).join(windows, "win"), "near-rare")
    lists = (
        tokens(docs)
        .join(rare.select("term", "win_id", "place"), "term")
        .withColumn("tile", F.floor(F.col("position") / (distance + 1)))
        .distinct()
    )
    first, second = lists.filter("place = 0").alias("a"), lists.filter(f"place = {RAREST - 1}")
    beside = second.withColumn("tile", F.explode(F.array(F.col("tile") - 1, "tile", F.col("tile") + 1))).alias("b")
    return (
        first.join(beside, ["text_id", "win_id", "tile"])
        .filter(F.abs(F.col("a.position") - F.col("b.position")) <= distance)
        .select("text_id", "win_id", F.least("a.position", "b.position").alias("start"))
        .distinct()
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    docs = documents.select(text_key(F.col("text")).alias("text_id"), "text")
    windows = written(benchmark_windows(benchmark), "leak-windows")
    bad = written(occurrences(docs, windows).select("text_id"), "leak-bad")
    own = documents.select(F.struct("*").alias("row"), text_key(F.col("text")).alias("text_id"))
    return own.join(bad, "text_id", "left_anti").select("row.*")


ORACLE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, len(w[i:i + 9])::BIGINT AS n, array_to_string(w[i:i + 9], ' ') AS said
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)
), place AS (
  SELECT row, w, unnest(generate_series(1, len(w))) AS i FROM doc
), hit AS (
  SELECT row, i, n, item_id FROM (SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS said FROM place, (SELECT DISTINCT n FROM win) WHERE i + n - 1 <= len(w)) JOIN win USING (n, said)
), word AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY row
), items AS (
  SELECT row, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT row, item_id FROM hit) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN word USING (row) LEFT JOIN items USING (row)
"""
