"""Exact top-k search by inner product with a pivot table.

Every vector's distances to PIVOTS fixed vectors are computed for each pair of blocks. By the triangle inequality their
differences bound the distance of a query and a candidate from below, hence their inner product from above; the best of
all pivots counts. A query's 4k candidates of highest bound are evaluated first; what the others can still reach by their bound
is compared with the k-th best score found, and queries with any candidate left are multiplied with the whole block, of
which only those candidates are looked at. The result is exact; on vectors without clusters the bounds save few products. Queries and candidates are dealt in blocks, and a task holds one block of each. A first pass over one
block of candidates gives every query a score to beat, so that other blocks return only what can still be among the best.

Vectors are whole numbers, sums are exact below 2**53.

Defined cases: vectors that are null or hold a null or a number that is not finite take no part, nor do rows without an id;
an empty vector scores 0; of vectors of different lengths the shorter is filled with zeros; repeated rows are
candidates one by one, a query's own are all rows of its id, and of several rows of one query id the least vector asks; ties go to the smaller id; with fewer candidates
than k, all are returned; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystock.llm.ship import ship
from tallystock.session import materialize

PIVOTS = 16
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """Rows (id, v) of usable vectors, every component x turned into floor(scale * x)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & ~bad)
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return usable.select(F.col(id_column).cast("long").alias("id"), numbers.alias("v"))


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    column = rows["v"].combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    if len(column):
        place = np.arange(width)[None, :] < sizes[:, None]
        out[place] = column.flatten().to_numpy()
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _bounds(queries: np.ndarray, x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Upper bounds of all products, in single precision and widened by more than its rounding."""
    far_q, far_x = _distances(queries, pivots).astype(np.float32), _distances(x, pivots).astype(np.float32)
    square_q, square_x = (queries * queries).sum(1), (x * x).sum(1)
    apart = np.zeros((len(queries), len(x)), np.float32)
    for p in range(far_q.shape[1]):
        one = far_q[:, p, None] - far_x[None, :, p]
        np.maximum(apart, np.abs(one, out=one), out=apart)
    apart -= np.float32(1e-5) * (far_q.max(initial=0) + far_x.max(initial=0))
    np.maximum(apart, 0, out=apart)
    bound = ((square_q[:, None] + square_x[None, :]) / 2).astype(np.float32)
    bound -= apart * apart / 2
    bound += np.float32(1e-5 * (square_q.max() + square_x.max()) + 1e-3)
    return bound


def best_of_block(queries: np.ndarray, beat: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray,
                  pivots: np.ndarray, k: int) -> tuple[list[int], list[int], list[int], int]:
    """Of each query the k best of ``x`` that score ``beat`` or more: places of query and candidate, scores, and how
    many candidates had to be evaluated.

    The candidates of highest bound are evaluated first and give the score to reach; then those whose bound
    still reaches it, by one matrix product for all queries that have any; what it gives for others is not looked at.
    """
    at_q, at_x, scores = [], [], []
    if not len(x) or not len(queries):
        return at_q, at_x, scores, 0
    bound = _bounds(queries, x, pivots)
    bound[own[:, None] == ids[None, :]] = -np.inf
    bound[bound < beat[:, None]] = -np.inf
    head = min(4 * k, len(x))
    first = np.argpartition(-bound, head - 1, axis=1)[:, :head]
    used = np.take_along_axis(bound, first, 1) > -np.inf
    first_score = np.where(used, np.einsum("qkd,qd->qk", x[first], queries), -np.inf)
    least = beat
    if head >= k:
        least = np.maximum(beat, np.partition(first_score, head - k, axis=1)[:, head - k])
    left = (bound >= least[:, None]) & (bound > -np.inf)
    np.put_along_axis(left, first, False, 1)
    rest = np.flatnonzero(left.any(1))
    rest_score = dict(zip(rest.tolist(), queries[rest] @ x.T, strict=True))
    for q in range(len(queries)):
        at, score = first[q], first_score[q]
        if q in rest_score:
            more = np.flatnonzero(left[q] & (rest_score[q] >= least[q]))
            at, score = np.concatenate([at, more]), np.concatenate([score, rest_score[q][more]])
        good = np.flatnonzero((score >= least[q]) & (score > -np.inf))
        good = good[np.lexsort((ids[at[good]], -score[good]))[:k]]
        at_x += at[good].tolist()
        scores += score[good].astype(np.int64).tolist()
        at_q += [q] * len(good)
    return at_q, at_x, scores, int(used.sum() + left.sum())


def _searcher(pivots: np.ndarray, k: int) -> Callable:
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        width = pivots.shape[1]
        q, x = _matrix(queries, width), _matrix(candidates, width)
        q_ids = queries["id"].to_numpy() if len(queries) else np.zeros(0, np.int64)
        ids = candidates["id"].to_numpy() if len(candidates) else np.zeros(0, np.int64)
        beat = queries["beat"].to_numpy() if len(queries) else np.zeros(0)
        at_q, at_x, scores, _ = best_of_block(q, beat, q_ids, x, ids, pivots, k)
        return pa.table({"query_id": pa.array(q_ids[np.array(at_q, np.int64)]), "vec_id": pa.array(ids[np.array(
            at_x, np.int64)]), "score": pa.array(scores, pa.int64())})
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best of all ``vectors`` (id, v) for each of them that is a query."""
    stored = materialize(vectors, "vectors")
    n, n_queries, width = stored.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    table = stored.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
    points = np.zeros((len(table), width or 0))
    for row, pivot in zip(points, table, strict=True):
        row[:len(pivot.v)] = pivot.v
    blocks, query_blocks = max(1, math.ceil(n / candidate_block)), max(1, math.ceil(n_queries / query_block))
    spread = lambda name, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    numbered = stored.withColumn("c", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    queries = stored.where(is_query).groupBy("id").agg(F.min("v").alias("v")).withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    search = _searcher(points, k)

    first = numbered.where("c = 0").select("id", "v", "c", spread("q", query_blocks))
    # Both sides come from one table, so one of them gets columns of its own.
    asked = queries.select(F.col("id").alias("id"), F.col("v").alias("v"), F.col("q").alias("q"), F.lit(float("-inf")).alias("beat"))
    found = materialize(first.groupBy("q").cogroup(asked.groupBy("q")).applyInArrow(search, _FOUND), "first")
    if blocks > 1:
        beat = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(
            F.col("n") >= k).select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("beat"))
        asked = queries.join(beat, "id", "left").select(
            F.col("id").alias("id"), F.col("v").alias("v"), F.col("q").alias("q"), F.coalesce("beat", F.lit(float("-inf"))).alias("beat"), F.explode(
                F.sequence(F.lit(1), F.lit(blocks - 1))).alias("c"))
        rest = numbered.where("c > 0").select("id", "v", "c", spread("q", query_blocks))
        found = found.unionAll(rest.groupBy("c", "q").cogroup(asked.groupBy("c", "q")).applyInArrow(search, _FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, F.col("id") % 20 == 0, 20)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""
