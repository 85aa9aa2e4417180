import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from support import docs, shipped  # noqa: F401
from tallystock.llm import sharding, top_k
from tallystock.llm.components import connected


def brute(vectors, k):
    out = set()
    for q, a in {q: a for q, a in vectors if q % 4 == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), c) for c, b in vectors if c != q)
        out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])}
    return out


def test_top_k_is_exact(spark):
    r = random.Random(1)
    rows = [(k, [r.choice([-1.0, 0.5, 0.01, 2.0, r.random()]) for _ in range(6)]) for k in range(300)]
    odd = [(301, None), (302, [1.0, None]), (304, [math.nan] * 6), (308, [math.inf] * 6), (None, [1.0] * 6), (312, []), (316, [0.5, 0.5])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows + odd], "vec_id long, embedding array<double>, score string")
    vectors = top_k.whole_vectors(df)
    whole = [(k, [math.floor(64 * x) for x in v]) for k, v in rows] + [(312, []), (316, [32, 32])]
    for k, block in ((5, 40), (20, 8192), (400, 64)):
        found = top_k.top_k(vectors, F.col("id") % 4 == 0, k, pivots=4, query_block=16, candidate_block=block).collect()
        assert {tuple(x) for x in found} == brute(whole, k) and len(found) == len(brute(whole, k))


def test_top_k_leaves_out_far_candidates():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (50, 8)) + 40, rng.normal(0, 1, (950, 8)) - 40])
    *_, computed = top_k.best_of_block(x[:1], np.array([-np.inf]), np.array([0]), x, np.arange(1000), x[:4], 5)
    assert computed < 200


def test_top_k_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])], "id long, v array<double>")
    assert [(x.vec_id, x.score) for x in top_k.top_k(df, F.col("id") == 0, 3).collect()] == [(1, 2), (1, 2)]
    assert top_k.top_k(df.limit(0), F.col("id") == 0, 3).collect() == []


def least_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, n, c = (lo + hi) // 2, 1, 0
        for x in sizes:
            if c + x > mid:
                n, c = n + 1, 0
            c += x
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


def test_search_finds_the_least_capacity(monkeypatch):
    monkeypatch.setattr(sharding, "COARSE", 6)
    monkeypatch.setattr(sharding, "FINE", 3)
    r = random.Random(3)
    for _ in range(300):
        sizes = [r.choice([1, 1, 2, 3, 50, r.randint(1, 400)]) for _ in range(r.randint(1, 100))]
        shards, upto = r.randint(1, 9), np.cumsum(sizes).tolist()

        def split(stretches, parts, upto=upto):
            out = {}
            for lo, hi in stretches:
                by = {}
                for u in upto:
                    if lo < u <= hi:
                        by.setdefault(int((u - lo - 1) / ((hi - lo) / parts)), []).append(u)
                out[lo, hi] = [(min(v), max(v), len(v)) for v in by.values()]
            return out
        capacity, cuts = sharding.minimax_cuts(upto[-1], shards, split)
        assert capacity == least_capacity(sizes, shards)
        assert len(cuts) == shards and all(c in upto or c == 0 for c in cuts) and cuts[-1] == upto[-1]
        assert all(0 <= b - a <= capacity for a, b in zip([0, *cuts], cuts, strict=False))


def test_shards_hold_whole_groups(docs):
    r = random.Random(4)
    texts = [(k, "hot text " * 20) for k in range(200)] + [(200 + k, "é" * r.randint(0, 300)) for k in range(400)]
    texts += [(None, None), (3, None), (3, "x"), (3, "x")]
    rows = sharding.assign_shards(docs(texts), keep=("text", "extra")).collect()
    assert len(rows) == len(texts)
    by_text, sizes, slots = {}, {}, {}
    for x in rows:
        body = (x.text or "").encode()
        assert (x.size, x.text_crc32) == (len(body) + 1, zlib.crc32(body))
        assert by_text.setdefault(x.text or "", x.shard) == x.shard
        sizes[x.shard] = sizes.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = by_text["hot text " * 20]
    others = [v for k, v in sizes.items() if k != hot]
    assert len(others) == 7 and max(others) - min(others) <= 2000 < sum(others) / 14
    assert sharding.assign_shards(docs([])).collect() == []


def test_components_of_chains_and_stars(spark):
    r = random.Random(5)
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(300, 300), (400, 401), (401, 400)]
    r.shuffle(links)
    found = {x.node: x.component for x in connected(spark.createDataFrame([*links, (None, 5)], "x long, y long")).collect()}
    want = {k: 0 for k in range(61)} | {100 + k: 100 for k in range(50)} | {400: 400, 401: 400}
    assert found == want
    assert connected(spark.createDataFrame([], "x long, y long")).collect() == []
