import math
import random

import pytest
from pyspark.sql import functions as F

from support import shipped  # noqa: F401
from tallystock.llm import centroids as c
from tallystock.llm import hard_negatives as h

ODD = [(900, None), (901, [1.0, None, 0.0]), (902, [math.nan] * 3), (903, [math.inf] * 3)]


def lloyd(vectors, start, rounds):
    centers = [list(x) for x in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), k) for k, x in enumerate(centers))
    for _ in range(rounds):
        groups = {}
        for v in vectors:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, own in groups.items():
            centers[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [nearest(v) for v in vectors], centers


@pytest.mark.parametrize("k,rounds", [(1, 3), (5, 10), (50, 2)])
def test_clusters_are_those_of_plain_rounds(spark, k, rounds):
    r = random.Random(k)
    rows = [(n, [r.choice([-2.0, 0.3, 1.7]) + r.random() / 9 for _ in range(3)]) for n in range(30)]
    rows += [(n, [0.5, -0.5, 0.25]) for n in range(30, 60)] + [(7, [3.0, 3.0, 3.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(n, v, "x", 0) for n, v in rows + ODD + [(904, [1.0])]], "vec_id long, embedding array<float>, cluster string, v int")
    vectors = c.whole_vectors(df, width=3)
    whole = {(x.id, tuple(x.v)) for x in vectors.collect()}
    assert vectors.count() == len(rows)
    assert whole == {(n, tuple(math.floor(1024 * x) for x in v)) for n, v in zip(
        (n for n, _ in rows), [[float(y) for y in x.embedding] for x in df.limit(len(rows)).collect()], strict=True)}
    found, centers = c.cluster(vectors, k, rounds)
    start = c.starts(vectors, k, "3:")
    ids = [(x.id, list(x.v)) for x in vectors.collect()]
    near, want = lloyd([v for _, v in ids], start, rounds)
    assert centers == want
    assert sorted(map(str, ((x.id, x.distance, x.cluster) for x in found.collect()))) == sorted(
        map(str, ((n, d, g) for (n, _), (d, g) in zip(ids, near, strict=True))))


def test_clusters_without_rows_and_with_large_numbers(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    found, centers = c.cluster(c.whole_vectors(empty), 3, 2)
    assert found.collect() == [] and centers == []
    with pytest.raises(ValueError, match="too large"):
        c.cluster(c.whole_vectors(spark.createDataFrame([(1, [1e300])], empty.schema)), 3, 2)
    far = spark.createDataFrame([(n, [-4.0 if n % 2 else 4.0]) for n in range(10)], empty.schema)
    found, centers = c.cluster(c.whole_vectors(far, scale=1), 2, 5)
    assert {abs(x[0]) for x in centers} == {4} and {x.distance for x in found.collect()} <= {0, 64}


def test_cluster_rounds_move_no_rows(spark):
    from conftest import plan_of
    df = spark.createDataFrame([(n, [float(n), 1.0]) for n in range(9)], "vec_id long, embedding array<double>")
    plan = plan_of(c.whole_vectors(df).select(c.nearest([[1, 2], [3, 4]])["cluster"].alias("cluster")))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def mined(rows, step, positives, negatives, low, high):
    out = []
    for a, label, v in rows:
        if a % step:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w, strict=False))  # noqa: E731, B023
        others = sorted((-score(w), n, own) for n, own, w in rows if n != a)
        for s, n, own in [x for x in others if x[2] == label][:positives]:
            good = [(m, -t) for t, m, o in others if o != label and low * -s <= 100 * -t <= high * -s]
            out += [(a, n, k + 1, m, -s, t) for k, (m, t) in enumerate(good[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("positives,negatives,block_bytes", [(5, 10, 16 << 20), (3, 2, 40), (40, 500, 16 << 20), (1, 1, 100)])
def test_negatives_are_those_of_all_windows(spark, positives, negatives, block_bytes):
    r = random.Random(positives)
    rows = [(n, r.choice([0, 0, 0, 1, 2]), [r.choice([-1.0, 0.5, 0.7, r.random()]) for _ in range(4)]) for n in range(150)]
    rows += [(n, n % 2, [0.5, 0.5, 0.5, 0.5]) for n in range(150, 260)]
    odd = [(None, 1, [1.0] * 4), (300, None, [1.0] * 4), (310, 1, []), *((n, 1, v) for n, v in ODD)]
    df = spark.createDataFrame([(n, label, v, "x") for n, label, v in rows + odd], "vec_id long, label int, embedding array<double>, id string")
    found = h.mine(h.labelled_vectors(df), F.col("id") % 10 == 0, positives, negatives, 30, 90, block_bytes).collect()
    whole = [(n, label, [math.floor(256 * x) for x in v]) for n, label, v in rows] + [(310, 1, [])]
    assert sorted(map(tuple, found)) == mined(whole, 10, positives, negatives, 30, 90)


def test_negatives_of_repeated_anchors_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1.0], 1), (0, [1.0], 1), (0, [9.0], 2), (1, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (2, [0.5], 2), (3, [-1.0], 1)]
    found = h.mine(h.labelled_vectors(spark.createDataFrame(rows, schema), scale=2), F.col("id") == 0, 3, 5, 30, 90)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 2, 4, 2), (0, 1, 1, 2, 4, 2), (0, 1, 2, 2, 4, 2), (0, 1, 2, 2, 4, 2)]
    assert h.mine(h.labelled_vectors(spark.createDataFrame([], schema)), F.col("id") == 0, 3, 5, 30, 90).collect() == []
    assert h.windows([100, 0, -10, 7], 30, 90) == [(30, 90), (0, 0), (3, 6)]
    with pytest.raises(ValueError, match="too large"):
        h.mine(h.labelled_vectors(spark.createDataFrame([(1, [1e9], 1)], schema)), F.col("id") == 0, 3, 5, 30, 90)
