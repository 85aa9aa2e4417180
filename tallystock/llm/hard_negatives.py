"""Hard-negative mining by slots: for every anchor and positive, rows of other labels that score a little less.

A positive of score p asks for the best rows of other labels whose scores lie between a lower and an upper share of p. The
windows of one anchor overlap, but their upper limits cut all scores into disjoint slots, and the first rows of a window are
the first of its own slot and of those below. So every task keeps only the best k rows of each slot, a merge of tasks
keeps the best k again, and one descending list of at most k rows a slot answers all windows of the anchor: its part
from the positive's slot on down, as far as the lower limit.

Anchors are taken in blocks of bounded size, which are broadcast; all rows stay where they are stored and are read once a
block for the positives and once for the slots. Tasks send what they keep, so a hot label moves no more than others.
Scores are whole numbers and exact.

Defined cases: rows without an id or a label, and vectors that are null or hold a null or a number that is not finite,
take no part; vectors of different lengths are filled with zeros; ties go to the smaller id; all rows of the anchor's id
are left out of its positives and negatives; a repeated anchor id is one anchor, of its least vector, and other repeated
rows count one by one; a positive without a row in its window (every one of negative score) gives no rows; an empty table
gives no rows; components too large for exact scores raise an error before any search; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystock.llm.ship import ship
from tallystock.llm.vectors import extent, floored, matrix, usable
from tallystock.session import materialize, new_path

BLOCK_BYTES = 16 << 20  # of anchor vectors that a task holds
_PRODUCTS = 1 << 21  # scores that a task looks at together
_NONE = -(1 << 50)  # below all scores
_ROWS = 1 << 12


def labelled_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
                     scale: int = 256) -> DataFrame:
    """Rows (id, label, v) of usable vectors, every component x turned into floor(scale * x)."""
    return df.select(F.col(id_column).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias(
        "label"), F.when(usable(vector), floored(vector, scale)).alias("v")).dropna()


class Best:
    """The k best (score, id) pairs of every anchor, ties to the smaller id."""

    def __init__(self, anchors: int, k: int):
        self.scores = np.full((anchors, k), _NONE, np.int64)
        self.ids = np.full((anchors, k), np.iinfo(np.int64).max, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of every anchor (rows) with candidates of ascending ids (columns); _NONE takes no part."""
        k, n = self.scores.shape[1], len(ids)
        if n > k:
            # Score and place make one number, so that the first k are told apart within ties.
            keys = scores * _ROWS + np.arange(_ROWS - 1, _ROWS - 1 - n, -1)
            place = np.argpartition(keys, n - k, axis=1)[:, n - k:]
            scores, ids = np.take_along_axis(scores, place, 1), ids[place]
        else:
            ids = np.broadcast_to(ids, scores.shape)
        scores, ids = np.hstack([self.scores, scores]), np.hstack([self.ids, ids])
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
        self.scores, self.ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, id and score of all that was kept."""
        anchor, place = np.nonzero(self.scores > _NONE)
        return anchor, self.ids[anchor, place], self.scores[anchor, place]


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray
            ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ascending ids, products with all anchors, equal labels and other ids, for a few candidates at a time."""
    step = max(1, min(_ROWS, _PRODUCTS // max(1, len(ids))))
    for batch in batches:
        order = np.argsort(batch.column(0).to_numpy(zero_copy_only=False), kind="stable")
        for at in range(0, len(order), step):
            part = batch.take(pa.array(order[at:at + step]))
            own, label = part.column(0).to_numpy(), part.column(1).to_numpy()
            products = (vectors @ matrix(part.column(2), vectors.shape[1]).T).astype(np.int64)
            yield own, products, labels[:, None] == label[None, :], ids[:, None] != own[None, :]


def _positives(block: Broadcast, k: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = block.value
        best = Best(len(ids), k)
        for own, products, same, other in _scored(batches, ids, labels, vectors):
            best.add(np.where(same & other, products, _NONE), own)
        anchor, found, score = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(ids[anchor]), pa.array(found), pa.array(score)], ["anchor_id", "id", "score"])
    return search


def _slots(block: Broadcast, limits: Broadcast, k: int) -> Callable:
    """``limits``: of every anchor the upper limits of its slots, descending, then the lower end of the last one."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = block.value
        edges = limits.value
        best = [Best(len(ids), k) for _ in range(edges.shape[1] - 1)]
        for own, products, same, other in _scored(batches, ids, labels, vectors):
            products[same | ~other] = _NONE
            for slot, kept in enumerate(best):
                inside = (products <= edges[:, slot, None]) & (products > edges[:, slot + 1, None])
                if inside.any():
                    kept.add(np.where(inside, products, _NONE), own)
        for slot, kept in enumerate(best):
            anchor, found, score = kept.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[anchor]), pa.array(np.full(len(anchor), slot, np.int32)), pa.array(found), pa.array(score)],
                ["anchor_id", "slot", "id", "score"])
    return search


def _first(found: DataFrame, by: list[str], k: int, name: str = "rank") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def windows(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """Least and greatest whole score between ``low`` and ``high`` hundredths of each score, without empty windows."""
    found = [(-(-low * p // 100), high * p // 100) for p in scores]
    return [(least, most) for least, most in found if least <= most]


def _edges(ids: np.ndarray, scores: dict[int, list[int]], low: int, high: int, slots: int) -> np.ndarray:
    edges = np.full((len(ids), slots + 1), _NONE, np.int64)
    for row, anchor in enumerate(ids.tolist()):
        own = windows(scores.get(anchor, []), low, high)
        if own:
            upper = sorted({most for _, most in own}, reverse=True)
            edges[row, :len(upper)] = upper
            edges[row, len(upper):] = min(least for least, _ in own) - 1
    return edges


def mine(vectors: DataFrame, is_anchor: Column, positives: int, negatives: int, low: int, high: int,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are the best ``positives`` rows of its label; each has the best ``negatives`` rows of other labels that
    score between ``low`` and ``high`` hundredths of it.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    stored = materialize(vectors, "vectors")
    _, width = extent(stored, -_NONE)
    anchors = stored.where(is_anchor).groupBy("id").agg(F.min(F.struct("v", "label")).alias("a"))
    blocks = max(1, math.ceil(anchors.count() * max(1, width) * 8 / block_bytes))
    anchors = materialize(anchors.select("id", "a.label", "a.v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")), "anchors")
    near_path, slot_path = new_path(spark, "positives"), new_path(spark, "slots")
    for number in range(blocks):
        table = anchors.where(F.col("block") == number).toArrow().combine_chunks()
        ids = table["id"].to_numpy()
        points = matrix(table["v"].combine_chunks(), width) if len(table) else np.zeros((0, width))
        block = context.broadcast((ids, table["label"].to_numpy(), points))
        near = stored.mapInArrow(_positives(block, positives), "anchor_id long, id long, score long")
        near = materialize(_first(near, ["anchor_id"], positives).select("anchor_id", "id", "score"), "near")
        scores: dict[int, list[int]] = {}
        for anchor, _, score in near.collect():  # at most ``positives`` for each anchor of the block
            scores.setdefault(anchor, []).append(score)
        limits = context.broadcast(_edges(ids, scores, low, high, positives))
        slots = stored.mapInArrow(_slots(block, limits, negatives), "anchor_id long, slot int, id long, score long")
        near.write.mode("append").parquet(near_path)
        _first(slots, ["anchor_id", "slot"], negatives).drop("rank").write.mode("append").parquet(slot_path)
        block.unpersist()
        limits.unpersist()
    near = spark.read.schema("anchor_id long, id long, score long").parquet(near_path)
    slots = spark.read.schema("anchor_id long, slot int, id long, score long").parquet(slot_path)
    # Slots follow each other downwards, so sorting by score merges them into one list for all windows of the anchor.
    merged = slots.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("below"), "id"))), lambda e: F.struct(e["id"].alias("id"), (-e["below"]).alias("score"))).alias("ranked"))
    window = F.filter("ranked", lambda e: (F.lit(low) * F.col("score") <= 100 * e["score"]) & (100 * e["score"] <= F.lit(high) * F.col("score")))
    answers = near.join(merged, "anchor_id").select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.posexplode(F.slice(window, 1, negatives)).alias("place", "e"))
    return answers.select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("e.id").alias("negative_id"),
                          "positive_score", F.col("e.score").alias("negative_score"))


def op13(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=label)
    return mine(vectors, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
