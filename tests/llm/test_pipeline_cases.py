"""The pipeline's stages on odd tables: clashing names, null and repeated ids, no rows."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from support import shipped  # noqa: F401

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as c  # noqa: E402

CLASH = ["_id", "_chunk", "_copy", "kept", "score", "removed", "secrets", "n_words", "node", "component_id", "other_columns", "_new_text", "_key"]


def prose(r, n=80):
    return " ".join("".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("int"))
        for name in CLASH:
            docs = docs.withColumn(name, F.lit(f"mine {name}"))
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        labels = [(d, 1, 0) for d, _ in rows if d is not None][:20] or [(1, 1, 0)]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)
    return write


def test_stages_keep_other_columns_and_rows(spark, folder):
    r = random.Random(1)
    one, two, shared = prose(r), prose(r), prose(r, 60)
    rows = [(3, one), (7, one + " end"), (7, two), (9, two), (9, two), (None, prose(r)), (None, None), (4, None), (4, ""),
            (20, prose(r) + " " + shared), (21, prose(r) + " " + shared), (22, prose(r) + " password=abcdef123456")]
    sf = folder(rows)
    docs = spark.read.parquet(sf + "/documents.parquet")
    names = docs.columns
    for _, stage in c.STAGES[:-1]:
        docs = c.materialize(stage(spark, docs, sf), "stage")
        assert docs.columns == names and docs.schema["n_chars"].dataType.simpleString() == "int"
        for row in docs.collect():
            assert all(row[n] == f"mine {n}" for n in CLASH) and row.n_chars == len(row.text)
    found = {x.doc_id: x.text for x in docs.collect()}
    assert set(found) == {3, 7, 20, 21, 22, None} and docs.count() == 6
    assert found[3] == one and found[7] == two and "[SECRET]" in found[22]
    assert shared[:50] not in found[20] and shared[:50] not in found[21]
    packed = c.STAGES[-1][1](spark, docs, sf)
    assert {x.doc_id for x in packed.collect()} == set(found)


def test_no_documents(spark, folder):
    assert c.run(spark, folder([])).collect() == []
