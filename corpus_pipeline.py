"""A training corpus from raw documents: rules, near copies, repeated passages, secrets, packed sequences.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame; all but the
last return the columns of documents. Between stages the rows are written as Parquet and read again.

Defined cases: columns besides doc_id and text, whatever they are called, come back as they were (n_chars, if there is one, counts
the new text); to the operators they are one column, so no name can clash. A null or empty text fails the quality rules. Rows
of one doc_id are documents of their own; rows whose texts are near copies or equal leave one, of the smallest id, a null id first.
An empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock.llm.jaccard_join import keep_one
from tallystock.llm.packing import pack, token_pieces
from tallystock.llm.quality_rules import fit_quality, judge
from tallystock.llm.secret_scan import find_secrets, fit_secret_model, redact
from tallystock.llm.ship import ship
from tallystock.llm.substring_dedup import substring_dedup
from tallystock.session import materialize


_OTHERS = "other_columns"
BATCH_ROWS = 2000  # of whole documents that pass to a Python worker at once


def _small_batches(spark: SparkSession) -> None:
    """Bound what is in flight between Spark and its Python workers; a session that asks for less keeps it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` as doc_id, text and one column of all others."""
    _small_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("doc_id"), *others).alias(_OTHERS))


def _whole(found: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` from a table made of _apart(docs), with a new ``text`` or its own."""
    value = {c: F.col(_OTHERS)[c] for c in docs.columns} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if text is not None:
        found = found.withColumn("_new_text", text)
        value["text"] = F.col("_new_text")
        if "n_chars" in docs.columns:
            value["n_chars"] = F.length("_new_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[c.alias(name) for name, c in value.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or score below the threshold go."""
    ship(spark)
    own = _apart(docs)
    model = fit_quality(own, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _whole(judge(own, model).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    ship(spark)
    return _whole(keep_one(_apart(docs)), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur again are cut out of all texts; documents stay, also those that are empty then."""
    ship(spark)
    return _whole(substring_dedup(_apart(docs), layout=True), docs, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are overwritten by a mark."""
    own = _apart(docs)
    return _whole(redact(find_secrets(own, fit_secret_model(own))), docs, F.col("text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents."""
    ship(spark)
    _small_batches(spark)
    return pack(token_pieces(docs, ids=False, added=True))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("secret scans", secrets), ("best-fit packing", packing)]

ORACLE_SQL = None  # scores and token ids are beyond SQL; tests/llm holds the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
