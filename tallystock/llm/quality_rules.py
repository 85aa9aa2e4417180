"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Every run of ``width`` bytes of a text falls into one of 2**bits buckets. Bucket counts of all documents give the
raw multinomial, those of labelled good documents (quality 1, not toxic) the target. A document's score is the mean
log ratio of its n-grams. The threshold is the one that best splits labelled good from labelled bad
documents among those that the fixed rules on repetition and length pass, lower one first on ties. Every
document is held against rules and threshold.

Counts of the raw corpus and of the trusted documents, scores, rules and threshold cover all documents and all labels. Scores of
labelled documents stay in ranges of a shuffle; only ``label_rows``, where a caller sets it, limits the threshold to the labels of
smallest hashed id.

Defined cases: a null or empty text has no words and no n-grams, scores 0 and fails the length rule; without trusted
labels all scores are 0 and without bad labels no document falls below the threshold; repeated rows are judged
alike; an id that is null or has no label is scored like any other; labels given twice count once, and
contradicting ones count as bad; empty tables give no rows. All columns of the input stay; results
replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from tallystock.llm.ship import ship
from tallystock.llm.words import _BYTE, Rolling, Words, mix, slices, words
from tallystock.session import materialize

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = ", ".join(f"{c} long" for c in COUNTS) + ", score double, base_failed boolean, kept boolean"


@dataclass
class QualityModel:
    """Log ratio of each bucket, the lowest score that passes, and the n-gram width."""

    weights: np.ndarray
    threshold: float
    width: int


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams that lie in one row, and where each row's begin (and the last end)."""
    sizes = np.diff(offsets)
    per_row = np.maximum(sizes - width + 1, 0)
    first = np.concatenate([[0], np.cumsum(per_row)])
    if not first[-1]:
        return np.zeros(0, np.int64), first
    last = np.repeat(offsets[1:], sizes) - width
    at = np.flatnonzero(np.arange(len(data)) <= last)
    return (Rolling(_BYTE[data]).spans(at, at + width) >> np.uint64(64 - bits)).astype(np.int64), first


def _totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def _repeat_mask(hashes: np.ndarray) -> np.ndarray:
    _, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return counts[place] > 1


def text_counts(w: Words) -> dict[str, np.ndarray]:
    """The rule counts of each row."""
    rows, per_row = len(w.offsets) - 1, np.diff(w.first)
    word_row = np.repeat(np.arange(rows), per_row)
    covered = np.zeros(len(w.start), np.int64)
    at, hashes = w.windows(3)
    again = at[_repeat_mask(mix(hashes ^ mix(word_row[at].astype(np.uint64) + np.uint64(1))))]
    for k in range(3):
        covered[again + k] = 1

    breaks = np.flatnonzero(w.data == 10)
    start = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([breaks, w.offsets[1:]]), kind="stable")
    breaks_below = np.searchsorted(breaks, w.offsets)
    line_row = np.repeat(np.arange(rows), np.diff(breaks_below) + 1)
    filled = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    hashes = Rolling(_BYTE[w.data]).spans(start[filled], end[filled])
    line_row = line_row[filled]
    lines = np.bincount(line_row, minlength=rows)
    keyed = mix(hashes ^ mix(line_row.astype(np.uint64) + np.uint64(1)))
    different = np.bincount(line_row[np.unique(keyed, return_index=True)[1]], minlength=rows)

    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    in_word = np.ones(256, np.int64)
    in_word[[9, 10, 11, 12, 13, 32]] = 0
    in_word[128:192] = 0  # later bytes of a code point
    return {"n_words": per_row, "word_chars": _totals(in_word[w.data], w.offsets),
            "n_symbols": _totals(symbol[w.data], w.offsets), "n_dup_lines": lines - different,
            "n_repeat_words": _totals(covered, w.first)}


def _failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * n)


def _scores(part: pa.Array, weights: np.ndarray, width: int) -> tuple[Words, np.ndarray]:
    w = words(part)
    buckets, first = ngram_buckets(w.data, w.offsets, width, int(np.log2(len(weights))))
    value = weights[buckets]
    n = np.diff(first)
    score = np.zeros(len(n))
    if (some := n > 0).any():
        score[some] = np.add.reduceat(value, first[:-1][some]) / n[some]
    return w, np.round(score, 12)


def _count_rows(width: int, bits: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0)):
                w = words(part)
                buckets, _ = ngram_buckets(w.data, w.offsets, width, bits)
                total += np.bincount(buckets, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])
    return rows


def _bucket_counts(docs: DataFrame, width: int, bits: int) -> np.ndarray:
    counts = np.zeros(1 << bits)
    found = docs.select("text").mapInArrow(_count_rows(width, bits), "bucket long, n long")
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def _best_threshold(scored: DataFrame) -> float:
    """The cut midway between two scores that keeps most good and fewest bad ones, by share of each; ``scored``: (score, good).

    Shares below a score are running sums over ranges of scores; the driver gets the best row.
    """
    counted = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    ranged = materialize(counted.repartitionByRange("score").withColumn("range", F.spark_partition_id()), "label-scores")
    n_good, n_bad = ranged.agg(F.sum("good"), F.sum("bad")).first()
    if not n_good or not n_bad:
        return float("-inf")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ranged.groupBy("range").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).select(
        "range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("good", "bad")])
    below = {c: F.sum(c).over(inside) + F.col(f"{c}_before") for c in ("good", "bad")}
    value = F.rint((1 - below["good"] / n_good + below["bad"] / n_bad) * 1e9)
    best = ranged.join(F.broadcast(before), "range").select("score", value.alias("value")).orderBy(F.desc("value"), "score").first()
    if best.value <= 1e9:  # no cut is better than none
        return float("-inf")
    return (ranged.where(F.col("score") > best.score).agg(F.min("score")).first()[0] + best.score) / 2


def fit_quality(docs: DataFrame, labels: DataFrame, width: int = 4, bits: int = 16,
                label_rows: int | None = None) -> QualityModel:
    """Counts over all of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic), and a threshold from all labels or, if
    ``label_rows`` is given, from so many.

    The driver gets two rows per bucket.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") > 0).alias("_good"), (F.max(F.coalesce("toxic", F.lit(0))) > 0).alias("_toxic"))
    clean = known.where("not (_good and _toxic)").drop("_toxic")
    used = clean if label_rows is None else clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(label_rows)
    own = docs.select("doc_id", "text")
    raw = _bucket_counts(own, width, bits)
    trusted = clean.where("_good").hint("merge")  # labels grow with the documents: one kind of join at all sizes
    target = _bucket_counts(own.join(trusted, "doc_id", "left_semi"), width, bits)
    weights = np.zeros(1 << bits)
    if target.any():
        weights = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                w, score = _scores(part, weights, width)
                passed = np.flatnonzero(~_failed(text_counts(w)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)).take(pa.array(passed)), pa.array(score[passed])],
                    ["doc_id", "score"])

    # Every text is scored where it lies: ids and scores travel to the labels, no text does.
    scored = own.where("doc_id is not null").mapInArrow(rows, StructType([own.schema["doc_id"], StructField("score", DoubleType())]))
    judged = scored.join(used.hint("merge"), "doc_id").select("score", F.col("_good").alias("good"))
    return QualityModel(weights, _best_threshold(judged), width)


def judge(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the rules, the score, base_failed and kept."""
    added = StructType.fromDDL(ADDED)
    docs = docs.drop(*added.names)
    schema = StructType([*docs.schema.fields, *added.fields])
    arrow, at = to_arrow_schema(schema), docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(at)):
                w, score = _scores(part, model.weights, model.width)
                counts = text_counts(w)
                failed = _failed(counts)
                new = [*(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(score), pa.array(failed),
                       pa.array(~failed & (score >= model.threshold))]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(part)) for c in batch.columns), *new], schema=arrow)
    return docs.mapInArrow(rows, schema)


def op7(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model).drop("text")
