"""Registered queries against their SQL, and the pipeline's stages against plain Python."""

import os
import re
import sys

import duckdb
import numpy as np
import pytest

from support import shipped  # noqa: F401
from tallystock import llm

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(llm.oracles()))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = llm.queries()[name](spark, SF)
    cursor = con.execute(llm.oracles()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.select(*names).collect()), key=key) == sorted(cursor.fetchall(), key=key)


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in llm.queries()} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "substring dedup", "secret scans", "best-fit packing"]


def test_pipeline(spark, tmp_path):
    from test_documents import counts, groups, removed_words
    from test_secret_scan import base_spans
    from tokenizers import Tokenizer

    from tallystock.llm.token_ids import default_tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {x.doc_id: x.text for x in docs.collect()}
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        rows = docs.collect()
        if k < 4:
            assert docs.columns == columns
            after = {x.doc_id: x.text for x in rows}
            assert len(after) == len(rows)
        if k == 0:
            failed = {d for d, t in before.items() if (n := counts(t))[0] < 50 or 2 * n[4] > n[0]}
            assert not failed & set(after) and all(labels.get(d, 1) for d in after)
            assert {d for d, q in labels.items() if q and d in before} - failed <= set(after)
        elif k == 1:
            assert set(after) == {d for d, n, c in groups(list(before.items())) if not n or c == d}
        elif k == 2:
            ids = sorted(before)
            for d, (gone, words) in zip(ids, removed_words([before[i] for i in ids], 35), strict=True):
                assert WORD.findall(after[d]) == [w for i, w in enumerate(words) if i not in gone]
                assert gone or after[d] == before[d]
        elif k == 3:
            for d, t in before.items():
                for start, _, end, _ in base_spans(t):
                    assert t[start:end] not in after[d]
                assert base_spans(t) or after[d] == t
        else:
            t = Tokenizer.from_file(default_tokenizer())
            sizes = {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in before.items()}
            placed, total = {}, {}
            for x in rows:
                placed.setdefault(x.sequence_id, []).append((x.offset, x.length))
                total[x.doc_id] = total.get(x.doc_id, 0) + x.length
            assert total == sizes
            for own in placed.values():
                own.sort()
                assert [a for a, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= 1024
            assert len(placed) <= 1.03 * sum(sizes.values()) / 1024 + 1
        if k < 4:
            before = after
