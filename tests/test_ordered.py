"""Distributed ordered operators against plain Python, with one group holding most rows."""

import random

from conftest import plan_of
from pyspark.sql import functions as F

from tallystock.operators import ordering as O
from tallystock.operators import windows as W


def test_fill_down_across_blocks(rows):
    rng = random.Random(1)
    data = [("hot", i, rng.choice(["a", "b"]) if rng.random() < 0.01 else None) for i in range(4, 3000)]
    data += [(f"s{k}", i, "t" if i == 7 else None) for k in range(20) for i in range(4, 20)]
    df = W.fill_down(rows(data, "s string, i int, v string"), "v", ["s"], "i", "filled", block=50)
    got = {(r.s, r.i): r.filled for r in df.collect()}
    last, expected = {}, {}
    for s, i, v in sorted(data):
        last[s] = v or last.get(s)
        expected[(s, i)] = last[s]
    assert got == expected


def test_fill_down_keeps_rows_without_a_group(rows):
    df = W.fill_down(rows([(None, 4, "a"), ("s", None, None), ("s", 5, "b")], "s string, i int, v string"), "v", ["s"], "i", "f")
    assert df.count() == 3


def test_number_rows_is_dense_and_ordered(rows):
    data = [(random.Random(i).randrange(5), i) for i in range(2000)]
    df = W.number_rows(rows(data, "g int, i int"), [F.col("g").desc(), F.col("i")])
    expected = {pair: n for n, pair in enumerate(sorted(data, key=lambda p: (-p[0], p[1])), 1)}
    assert {(r.g, r.i): r.RowNo for r in df.collect()} == expected


def test_running_total(rows):
    data = [(7 if i % 3 else i % 11, i) for i in range(3000)]
    df = W.running_total(rows(data, "v bigint, i int"), F.col("v"), [F.col("v").desc(), F.col("i")], "acc")
    total, expected = 0, {}
    for v, i in sorted(data, key=lambda p: (-p[0], p[1])):
        total += v
        expected[i] = total
    assert {r.i: r.acc for r in df.collect()} == expected


def test_empty_input(rows):
    none = rows([], "v bigint, i int")
    assert W.number_rows(none, [F.col("i")]).count() == 0
    assert W.running_total(none, F.col("v"), [F.col("i")], "acc").count() == 0


def test_first_per_key_limits_before_the_shuffle(rows):
    df = rows([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int").repartition(4)
    first = W.first_per_key(df, ["k"], [F.col("v").desc()])
    assert sorted((r.k or "", r.v) for r in first.collect()) == [("", 5), ("a", 2), ("b", 3)]
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_sort_splits_ties(rows):
    df = rows([(1, i) for i in range(5000)] + [(0, -1)], "k int, v int").repartition(8)
    ordered = O.sort_rows(df, F.col("k").desc())
    copies = O.sort_rows(df.select("k"), F.col("k").desc(), copies=True)
    assert [r.k for r in copies.collect()] == [1] * 5000 + [0]
    assert [r.k for r in ordered.collect()] == [1] * 5000 + [0]
    assert ordered.columns == ["k", "v"] and "_tie" in plan_of(ordered)


def test_share(rows):
    df = W.share_of_total(rows([("a", 1), ("b", 2)], "k string, v bigint"), "v", "p")
    assert {r.k: float(r.p) for r in df.collect()} == {"a": 33.33, "b": 66.67}
    zero = W.share_of_total(rows([("a", 0)], "k string, v bigint"), "v", "p")
    assert [r.p for r in zero.collect()] == [None]
