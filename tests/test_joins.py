"""Lookups with repeated, missing and null keys, and skew handling."""

from conftest import plan_of
from pyspark.sql import functions as F

from tallystock.operators import filters as R
from tallystock.operators import lookups as J
from tallystock.sources import tables as T


def _side(rows):
    return rows([("a", 2), ("a", 1), ("b", 3), (None, 9)], "k string, id int")


def test_lookups(rows):
    left = rows([("a",), ("b",), ("c",), (None,)], "c string")
    order = [F.col("id")]
    got = J.lookup_or_null(left, "c", _side(rows), "k", {"id": "found"}, order)
    assert sorted((r.c or "", r.found) for r in got.collect()) == [("", None), ("a", 1), ("b", 3), ("c", None)]
    kept = J.lookup_keep_original(left, "c", _side(rows), "k", "id", "found", order)
    assert sorted((r.c or "", r.found_unmatched) for r in kept.collect()) == [("", None), ("a", None), ("b", None), ("c", "c")]
    inner = J.lookup_inner(left, "c", _side(rows), "k", {"id": "found"}, order)
    assert sorted((r.c, r.found) for r in inner.collect()) == [("a", 1), ("b", 3)]


def test_lookup_in_place(rows):
    side = rows([("a", "x")], "k string, v string")
    got = J.lookup_in_place(rows([("a",), ("b",), (None,)], "c string"), "c", side, "k", "v")
    assert sorted(r.c or "" for r in got.collect()) == ["", "b", "x"]


def test_counts_are_zero_without_rows(rows):
    base = rows([(1,), (2,)], "id int")
    got = J.counts_per_key(rows([(1, True), (1, False)], "id int, p boolean"), "id", {"n": F.col("p")}, base)
    assert sorted((r.id, r.n) for r in got.collect()) == [(1, 1), (2, 0)]


def test_anti_join_null_key_is_new(rows):
    stored = rows([("a",), (None,)], "k string")
    got = T.anti_join_new_keys(rows([("a",), ("b",), (None,)], "k string"), stored, ["k"])
    assert sorted(r.k or "" for r in got.collect()) == ["", "b"]


def test_removed_values_keep_null(rows):
    df = rows([(1.0,), (2.5,), (6.0,), (None,)], "q double")
    assert sorted((r.q is None, r.q or 0) for r in R.remove_values(df, "q", [1, 2, 2.5]).collect()) == [(False, 6.0), (True, 0)]


def test_hot_key_is_split(spark, rows):
    """A code that holds most movements is joined by several tasks, not by one."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        n = F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id") % 500).cast("string")
        flow = spark.range(0, 60000, numPartitions=8).select(n.alias("code"), F.col("id"))
        master = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
        joined = J.lookup_inner(flow, "code", master, "k", {"v": "v"})
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
