"""Queries that SQL cannot express, run end to end over whole tables and held against plain Python."""

import hashlib
import zlib

import numpy as np
import pytest

from support import shipped  # noqa: F401
from tallystock import llm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {x.doc_id: x.text or "" for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name):
    return llm.queries()[name](spark, SF).collect()


def test_op1_base_columns(spark, texts):
    from test_secret_scan import base_spans
    rows = rows_of(spark, "op1_secret_scan")
    assert sorted(x.doc_id for x in rows) == sorted(texts)
    for x in rows:
        want = base_spans(texts[x.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert x.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (x.n_assign, x.n_access, x.n_hex) == tuple(sum(w[3] == k for w in want) for k in ("assign", "access", "hex"))
        found = x.spans.split(",") if x.spans else []
        assert [s for s in found if not s.startswith("markov")] == (listed.split(",") if listed else [])


def test_op5_shards(spark, texts):
    rows = rows_of(spark, "op5_sharding")
    assert sorted(x.doc_id for x in rows) == sorted(texts)
    totals, slots, groups = {}, {}, {}
    for x in rows:
        body = texts[x.doc_id].encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        totals[x.shard] = totals.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
        assert groups.setdefault(texts[x.doc_id], x.shard) == x.shard
    assert set(totals) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = {}
    for t in texts.values():
        sizes[t] = sizes.get(t, 0) + len(t.encode()) + 1
    assert max(totals.values()) <= sum(totals.values()) / 8 + max(sizes.values())


def test_op6_ids_are_those_of_the_library(spark, texts):
    from sentencepiece import SentencePieceProcessor

    from tallystock.llm.sentencepiece_ids import SPACE, default_model
    model = SentencePieceProcessor(model_file=default_model())
    rows = rows_of(spark, "op6_sentencepiece")
    assert sorted(x.doc_id for x in rows) == sorted(texts)
    for x in rows:
        ids = model.encode(texts[x.doc_id])
        assert (x.n_tokens, x.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert x.round_trip or SPACE in texts[x.doc_id]


def test_op7_counts_and_verdicts(spark, texts):
    from test_documents import counts
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = rows_of(spark, "op7_quality_rules")
    assert sorted(x.doc_id for x in rows) == sorted(texts)
    right = judged = 0
    for x in rows:
        want = counts(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == tuple(want)
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (x.base_failed and x.kept)
        if x.doc_id in labels and not x.base_failed:
            judged += 1
            right += x.kept == bool(labels[x.doc_id])
    assert right >= 0.9 * judged
