import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from support import docs, shipped  # noqa: F401
from tallystock.llm import packing, sentencepiece_ids, token_files
from tallystock.llm.token_ids import Encoder, default_tokenizer

PARTS = [" ", "  ", "\n", "\t", "a", "b c", "'s", "é", "3", "!!", "<|endoftext|>", "\x1c", "\r\n", "ｗ", "😀", "the", "\x85", "<s>", "国",
         "tion", "aaaa", "==", "     "]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)] + ["", " ", "\n", "\na", "a ", "a  b", "a\nb c"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_cut_parts_encode_like_whole_texts(library):
    texts = odd_texts(3000, 1)
    for text, ids in zip(texts, Encoder(default_tokenizer()).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    text = "Some WORDS  here\nand there"
    assert np.frombuffer(next(Encoder(path).encode([text])), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_best_fit_against_a_plain_search():
    r = random.Random(1)
    for _ in range(200):
        lengths = np.array([r.randint(1, 30) for _ in range(r.randint(0, 60))], np.int64)
        bins, places, fills = packing.best_fit(lengths, 30)
        plain = []
        for n in sorted(lengths.tolist(), reverse=True):
            fit = [k for k, f in enumerate(plain) if f + n <= 30]
            k = max(fit, key=lambda k: plain[k]) if fit else len(plain)
            plain[k:k + 1] = [(plain[k] if fit else 0) + n]
        assert sorted(fills.tolist()) == sorted(plain)
        assert sum(f <= 15 for f in fills) <= 1
        for b in range(len(fills)):
            own = sorted(zip(places[bins == b].tolist(), lengths[bins == b].tolist(), strict=True))
            assert [p for p, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def check_sequences(rows, capacity):
    by = {}
    for row in rows:
        by.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for own in by.values():
        own.sort()
        at = 0
        for offset, length in own:
            assert offset == at
            at += length
        assert at <= capacity
    return by


@pytest.mark.parametrize("leaf,fan", [(16_384, 8), (7, 2), (3, 3)])
def test_packing_places_every_piece(spark, leaf, fan):
    r = random.Random(leaf)
    data = [(k, r.choice([1, 2, 5, 33, 64, 63, 40, 10]), "keep") for k in range(300)] + [(None, 64, "keep"), (7, 9, "keep"), (7, 9, "keep")]
    df = spark.createDataFrame(data, "doc_id long, length int, sequence_id string")
    rows = packing.pack(df, capacity=64, leaf_items=leaf, fan=fan).collect()
    by = check_sequences(rows, 64)
    assert sorted((x.doc_id or -1, x.length) for x in rows) == sorted((d or -1, n) for d, n, _ in data)
    # Two pieces over half a sequence never share one; the leaves and the tree may leave some bins underfull.
    least = max(sum(n for _, n, _ in data) / 64, sum(n > 32 for _, n, _ in data))
    assert len(by) <= 1.1 * least + 300 / leaf + 1


def test_packing_odd_input(spark, docs):
    assert packing.pack(packing.token_pieces(docs([]))).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(2000,)], "length long"))
    nulls = packing.pack(spark.createDataFrame([(None,), (3,)], "length long")).collect()
    assert len(nulls) == 2


def test_pieces_hold_all_ids(docs, library):
    texts = [(1, "word " * 2500), (2, None), (3, ""), (4, "a\n b"), (4, "a\n b"), (None, "x")]
    rows = packing.token_pieces(docs(texts)).collect()
    long = sorted((x for x in rows if x.doc_id == 1), key=lambda x: x.piece)
    ids = library(texts[0][1]) + [2]
    assert [i for x in long for i in x.ids] == ids and [x.length for x in long[1:]] == [1024] * (len(long) - 1)
    assert [x.start for x in long] == [len(ids) % 1024 * (k > 0) + 1024 * max(k - 1, 0) for k in range(len(long))]
    assert [x.ids for x in rows if x.doc_id in (2, 3)] == [[2], [2]] and len([x for x in rows if x.doc_id == 4]) == 2


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(1, 9, rng.integers(1, 40))
        ids = rng.integers(0, rng.integers(1, 6) + 1, sizes.sum()).astype("<u4")
        g = token_files.Grammar.from_bytes(token_files.compress(ids, sizes, 2).to_bytes())
        assert (g.expand(g.symbols) == ids).all()
        for k, end in enumerate(np.cumsum(sizes)):
            own = ids[end - sizes[k]:end]
            a, b = sorted(rng.integers(0, sizes[k] + 1, 2))
            assert (g.document(k) == own).all() and (g.document(k, a, b) == own[a:b]).all()
    repeated = np.tile(np.arange(50, dtype="<u4"), 400)
    assert len(token_files.compress(repeated, np.array([len(repeated)])).symbols) < len(repeated) / 10


def test_token_files_read_back(spark, docs, library, tmp_path):
    r = random.Random(5)
    texts = [(k, t) for k, t in enumerate(odd_texts(200, 6))] + [(3, "again"), (500, None), (501, "many words " * 3000)]
    r.shuffle(texts)
    token_files.write_token_files(docs(texts), str(tmp_path / "f"), block_ids=100)
    rows = sorted(token_files.read_token_files(spark, str(tmp_path / "f")).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in rows] == sorted(d for d, _ in texts)
    at, by = 0, {}
    for d, t in texts:
        by.setdefault(d, []).append(t or "")
    for x in rows:
        assert x.start == at and any((np.array(library(t) + [0]).tolist() == x.ids) for t in by[x.doc_id])
        at += x.n_tokens
    digest = token_files.read_token_files(spark, str(tmp_path / "f"), ids=False).where("doc_id = 501").first()
    assert digest.ids_crc32 == zlib.crc32(np.array(library("many words " * 3000) + [0], "<u4").tobytes())
    token_files.write_token_files(docs([]), str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).collect() == []


def test_search_gives_the_models_ids():
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=sentencepiece_ids.default_model())
    own = sentencepiece_ids.Pieces(sentencepiece_ids.default_model())
    for text in odd_texts(1500, 8) + ["a" * 700, "tionthe" * 150, "-" * 300, " " * 100, "internationalization " * 20]:
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == model.encode(text)
        assert own.decode(ids) == text


def test_sentencepiece_columns(docs):
    rows = sentencepiece_ids.decode(sentencepiece_ids.encode(docs([(1, "a b"), (2, None), (None, ""), (1, "a b")]).withColumn(
        "ids", F.lit("clash")))).collect()
    assert [(r.decoded, len(r.ids) > 0) for r in rows] == [("a b", True), ("", False), ("", False), ("a b", True)]
    assert sentencepiece_ids.encode(docs([])).collect() == []


def test_queries_read_added_tokens_as_the_library_does(spark, tmp_path):
    import corpus_pipeline
    plain = Tokenizer.from_file(default_tokenizer())
    ids = lambda text: plain.encode(text, add_special_tokens=False).ids
    texts = ["end.<|endoftext|>Next page", "a <|endoftext|>\n b", "<|endoftext|", *odd_texts(300, 11)]
    assert ids(texts[0]) == [437, 13, 50256, 10019, 2443]
    for text, own in zip(texts, Encoder(default_tokenizer(), added=True).encode(texts), strict=True):
        assert np.frombuffer(own, "<u4").tolist() == ids(text)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    want = {k: zlib.crc32(np.array(ids(t) + [packing.END_ID], "<u4").tobytes()) for k, t in enumerate(texts)}
    for rows in (packing.op2(spark, str(tmp_path)), corpus_pipeline.packing(spark, df, str(tmp_path))):
        assert {x.doc_id: x.ids_crc32 for x in rows.collect()} == want
    want = {k: zlib.crc32(np.array(ids(t) + [token_files.END_ID], "<u4").tobytes()) for k, t in enumerate(texts)}
    assert {x.doc_id: x.ids_crc32 for x in token_files.op3(spark, str(tmp_path)).collect()} == want
