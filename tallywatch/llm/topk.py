"""Exact top-k search by inner product with a pivot table.

Distances of every vector to ``PIVOTS`` pivots are computed once. For a query and a
candidate the largest difference of their distances to a pivot is a lower bound of
their own distance, and so bounds the inner product from above. Candidates are
evaluated in the order of this bound until it falls below the k-th best score.

Queries and candidates are dealt to blocks of bounded size and each block of queries
meets each block of candidates once; a block pair returns its k best per query. The
work is that of a stated query set against all rows.

Defined results: vectors that are null or hold null or non-finite components take no
part; a query meets vectors of its own length only; repeated rows are candidates and
queries of their own, and a query leaves out one row equal to itself; a null id is
never a query and loses ties; an empty table gives an empty result. Scores that
would leave 64 bits raise an error. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.session import written

K = 5
EVERY = 50
PIVOTS = 16
PIVOT_LENGTHS = 16
QUERY_BLOCK = 1024
ROW_BLOCK = 8192
CHUNK = 128


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, vec, length, copies``: the vectors that take part, equal rows counted."""
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")).cast("long"))
    return (
        rows.filter(F.coalesce(usable, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec"))
        .groupBy("vec_id", "vec")
        .agg(F.count("*").alias("copies"))
        .withColumn("length", F.size("vec"))
    )


def matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    values = np.asarray(column.combine_chunks().flatten(), np.int64).reshape(len(column), length)
    if values.size and float(np.abs(values.astype(float)).max()) ** 2 * length >= 2.0**62:
        raise ValueError("components are too large for scores of 64 bits")
    return values


def pivot_table(vectors: DataFrame) -> dict[int, np.ndarray]:
    """A few vectors of each length, chosen by hash: at most ``PIVOTS * PIVOT_LENGTHS`` rows."""
    ranked = vectors.withColumn("nth", F.row_number().over(Window.partitionBy("length").orderBy(F.xxhash64("vec"), "vec", "vec_id")))
    rows = ranked.filter(F.col("nth") <= PIVOTS).orderBy("length", "nth").limit(PIVOTS * PIVOT_LENGTHS).select("length", "vec").collect()
    return {n: np.array([r["vec"] for r in rows if r["length"] == n], float).reshape(-1, n) for n in {r["length"] for r in rows}}


def best_in_block(queries: np.ndarray, rows: np.ndarray, own: list[list[int]], copies: np.ndarray, ids: np.ndarray, pivots: np.ndarray | None, k: int):
    """For each query the k best ``(row, times)`` of the block; ``own`` lists the rows equal to the query itself."""
    norms, query_norms = (rows.astype(float) ** 2).sum(1), (queries.astype(float) ** 2).sum(1)
    if pivots is None or not len(pivots):
        pivots = np.zeros((1, rows.shape[1]))
    to_pivot = np.sqrt(((rows[:, None, :] - pivots[None]) ** 2).sum(2)) if rows.size else np.zeros((len(rows), len(pivots)))
    query_to_pivot = np.sqrt(((queries[:, None, :] - pivots[None]) ** 2).sum(2)) if queries.size else np.zeros((len(queries), len(pivots)))
    for q, query in enumerate(queries):
        times = copies.copy()
        times[own[q]] -= 1
        gap = np.abs(to_pivot - query_to_pivot[q]).max(1)
        size = query_norms[q] + norms
        bound = (size - gap**2) / 2 + 1e-9 * size + 1
        order = np.argsort(-bound, kind="stable")
        at, least, seen_rows, seen_scores = 0, None, [], []
        while at < len(order) and (least is None or bound[order[at]] >= least):
            chunk = order[at : at + CHUNK]
            at += CHUNK
            chunk = chunk[times[chunk] > 0]
            seen_rows.append(chunk)
            seen_scores.append(rows[chunk] @ query)
            scores = np.concatenate(seen_scores)
            counts = times[np.concatenate(seen_rows)]
            if counts.sum() >= k:
                ranked = np.argsort(-scores, kind="stable")
                least = scores[ranked][np.searchsorted(np.cumsum(counts[ranked]), k)]
                keep = scores >= least
                seen_rows, seen_scores = [np.concatenate(seen_rows)[keep]], [scores[keep]]
        if seen_rows:
            found, scores = np.concatenate(seen_rows), np.concatenate(seen_scores)
            ranked, left = np.lexsort((ids[found], -scores)), k
            for r in ranked:
                if left <= 0:
                    break
                n = min(left, int(times[found[r]]))
                left -= n
                yield q, int(found[r]), int(scores[r]), n


NO_ID = np.iinfo(np.int64).max


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each query row; both as from ``integer_vectors``."""
    pivots = pivot_table(vectors)
    sizes = {name: max(1, -(-df.count() // block)) for name, df, block in (("rows", vectors, ROW_BLOCK), ("queries", queries, QUERY_BLOCK))}
    of = lambda name: F.pmod(F.xxhash64("vec_id", "vec"), F.lit(sizes[name])).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.lit(sizes[name] - 1)))
    left = queries.select("*", of("queries").alias("query_block"), every("rows").alias("row_block"))
    right = vectors.select("*", of("rows").alias("row_block"), every("queries").alias("query_block"))
    schema = pa.schema([("query_id", pa.int64()), ("times", pa.int64()), ("query", pa.list_(pa.int64())), ("vec_id", pa.int64()), ("score", pa.int64()), ("nth", pa.int64())])

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and held.num_rows:
            length = asked["length"][0].as_py()
            query, rows = matrix(asked["vec"], length), matrix(held["vec"], length)
            ids = np.array([NO_ID if i is None else i for i in held["vec_id"].to_pylist()], np.int64)
            query_ids, times, names = asked["vec_id"].to_pylist(), asked["copies"].to_pylist(), held["vec_id"].to_pylist()
            place: dict[tuple[int, bytes], int] = {(i, r.tobytes()): n for n, (i, r) in enumerate(zip(ids.tolist(), rows, strict=True))}
            own = [[place[x]] if (x := (i, q.tobytes())) in place else [] for i, q in zip(query_ids, query, strict=True)]
            found = best_in_block(query, rows, own, held["copies"].to_numpy().copy(), ids, pivots.get(length), k)
            for q, r, score, n in found:
                out += [(query_ids[q], times[q], query[q].tolist(), names[r], score, x) for x in range(n)]
        columns = list(zip(*out, strict=True)) or [()] * len(schema)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    keys = ["length", "row_block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id long, times long, query array<long>, vec_id long, score long, nth long"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "nth")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("again")).drop("again")


def search(rows: DataFrame) -> DataFrame:
    """The search of the rows whose id is divisible by ``EVERY`` against all others."""
    vectors = written(integer_vectors(rows), "topk-vectors")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 5
"""
