import math
import random
import re

import pytest
from pyspark.sql import functions as F

from support import docs, shipped  # noqa: F401
from tallystock.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(documents, items, length=10, coverage=1.0):
    """Of each document its words, hit places and items, by trying all windows of all items."""
    wanted = {}
    for number, text in items:
        w = split(text)
        if w:
            n = max(1, min(length, math.ceil(coverage * len(w))))
            for k in range(len(w) - n + 1):
                wanted.setdefault(tuple(w[k:k + n]), set()).add(number)
    out = []
    for number, text in documents:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                own = wanted.get(tuple(w[k:k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((number, len(w), hit, sorted(str(x) for x in found if x is not None)))
    return out


def corpus(r, words):
    items = [(k, " ".join(r.choices(words, k=r.choice([1, 3, 9, 10, 11, 30])))) for k in range(40)]
    items += [(40, items[5][1]), (41, None), (42, ""), (43, "?!"), (None, " ".join(r.choices(words, k=12)))]
    documents = []
    for k in range(120):
        parts = []
        for _ in range(r.randint(0, 6)):
            _, text = r.choice(items)
            own = (text or "").split()
            at = r.randint(0, max(0, len(own) - 3))
            parts += r.choices(words, k=r.randint(0, 8)) + [w.upper() + r.choice(["", ",", " -- "]) for w in own[at:at + r.randint(1, 40)]]
        documents.append((k, " ".join(parts)))
    return documents + [(200, None), (201, ""), (202, "?"), (None, items[3][1]), (7, items[5][1])], items


@pytest.mark.parametrize("length,coverage,group_bytes", [(10, 1.0, 4 << 20), (4, 0.5, 4 << 20), (10, 1.0, 500), (6, 0.8, 300)])
def test_leaks_are_those_of_all_windows(spark, docs, length, coverage, group_bytes):
    r = random.Random(length)
    documents, items = corpus(r, ["a", "b", "Ça", "été", "x1", "q", "zz", "w"])
    table = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    built = d.automata(table, length=length, coverage=coverage, group_bytes=group_bytes)
    assert (built.count() > 1) == (group_bytes < 4 << 20)
    rows = d.decontaminate(docs(documents), built, cut="clean").collect()
    found = sorted([(str(x.doc_id), x.n_words, x.n_hit, x.hit_items, sorted(
        p for a, b in zip(x.hit_words[::2], x.hit_words[1::2], strict=True) for p in range(a, b))) for x in rows], key=str)
    want = sorted([(str(k), n, len(hit), own, sorted(hit)) for k, n, hit, own in brute(documents, items, length, coverage)], key=str)
    assert found == want
    for x in rows:
        gone = {p for a, b in zip(x.hit_words[::2], x.hit_words[1::2], strict=True) for p in range(a, b)}
        assert split(x.clean) == [w for p, w in enumerate(split(x.text)) if p not in gone]
        assert gone or x.clean == x.text


def test_long_items_are_cut_without_losing_windows(spark, docs, monkeypatch):
    monkeypatch.setattr(d, "PIECE_WORDS", 7)
    r = random.Random(2)
    words = [f"w{k}" for k in range(50)]
    items = [(k, " ".join(r.choices(words, k=60))) for k in range(4)]
    documents = [(k, " ".join([*r.choices(words, k=5), *r.choice(items)[1].split()[r.randint(0, 20):r.randint(25, 60)]])) for k in range(40)]
    built = d.build([b for _, b in items], [10] * 4, [[str(k)] for k, _ in items])
    assert len(d.Reader(built).length) > 200
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k, _ in items]), pa.array([t for _, t in items])], ["id", "text"])
    pieces = [row for out in d._pieces(10, 1.0)(iter([batch])) for row in out.to_pylist()]
    assert len(pieces) == 4 * 8
    reader = d.Reader(d.build([p["body"] for p in pieces], [p["need"] for p in pieces], [[p["id"]] for p in pieces]))
    for (_, n, hit, own) in brute(documents, items):
        found = d.item_words(pa.array([documents[0][1]]))
        documents.pop(0)
        numbers, stretches = reader.stretches(found)
        leaks = [reader.leaks(numbers[a:b].tolist(), a) for a, b in stretches]
        assert {p for spans, _ in leaks for a, b in spans for p in range(a, b)} == hit
        assert sorted({i for _, states in leaks for x in reader.items(states) for i in reader.ids[x]}) == own


def test_hot_passage_and_very_long_text(spark, docs):
    passage = " ".join(f"passage{k}" for k in range(30))
    filler = " ".join(f"other{k}" for k in range(200_000))
    items = spark.createDataFrame([(k, f"{passage} tail{k}") for k in range(300)], "item_id long, text string")
    documents = [(k, f"before {passage} after") for k in range(500)] + [(1000, f"{filler} {passage} {filler}")]
    rows = {x.doc_id: x for x in d.decontaminate(docs(documents), d.automata(items), keep=["doc_id"]).collect()}
    assert len(rows) == 501 and all(x.n_hit == 30 and len(x.hit_items) == 300 for x in rows.values())
    assert rows[1000].hit_words == [200_000, 200_030]


def test_no_rows_and_clashing_columns(spark, docs):
    table = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert d.decontaminate(docs([]), d.automata(table)).collect() == []
    rows = d.decontaminate(docs([(1, "one two three")]), d.automata(table.limit(0)), cut="clean").collect()
    assert [(x.n_words, x.n_hit, x.hit_items, x.clean) for x in rows] == [(3, 0, [], "one two three")]
    odd = docs([(1, "One, two three four")]).withColumn("n_hit", F.lit("mine")).withColumn("_text", F.lit("kept")).withColumn("group", F.lit(4))
    row = d.decontaminate(odd, d.automata(table), cut="text").first()
    assert (row.n_hit, row._text, row.group, row.extra, row.text) == (3, "kept", 4, "x", " four")
