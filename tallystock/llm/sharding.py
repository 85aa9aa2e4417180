"""Sharding by minimax contiguous partition of groups of equal texts.

Groups are atomic and stand in the order of their least id; their sizes are added up once, range by range. The smallest
feasible capacity of a shard is searched by bisection, and a capacity is checked greedily: each shard reaches to the
last group that it can hold. The driver sees only marks of the running sum: first the last one of each of COARSE
equal stretches (and the first), then those of stretches that can still change the answer, until it is certain.
Within that capacity, the cuts are taken at the marks nearest to equal shares. A group larger than an equal share has
a shard of its own, and the rest is divided among the other shards.

Defined cases: null and empty texts are one group of size 1 a row; repeated rows are rows like any other and take slots of
their own; null ids come first; with fewer groups than shards, some shards stay empty; an empty table gives no rows;
other columns of the input are not read, but for those in ``keep``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.operators.windows import number_rows, running_total
from tallystock.session import materialize

SHARDS = 8
COARSE, FINE = 4096, 64


class Marks:
    """Known values of a running sum, and between which of them there may be others."""

    def __init__(self, total: int):
        self.at, self.open = [0, total], [True]

    def add(self, lo: int, hi: int, found: list[tuple[int, int, int]]) -> None:
        """``found``: first and last value and number of values of the parts of the stretch between two marks."""
        k = bisect_left(self.at, lo)
        inner, open_ = [], []
        for first, last, n in sorted(found):
            inner += [first, last] if n > 1 else [first]
            open_ += [False, n > 2] if n > 1 else [False]
        if not inner or inner[-1] != hi:  # the stretch ends at a known value, which its last part holds
            inner.append(hi)
            open_.append(False)
        self.at[k + 1:k + 2] = inner
        self.open[k:k + 1] = open_

    def below(self, t: int, at_most: bool) -> int:
        """The last value not above ``t``: the last known one, or with ``at_most`` an upper bound for it."""
        k = bisect_right(self.at, t) - 1
        return t if at_most and k < len(self.open) and self.open[k] and t > self.at[k] else self.at[k]

    def chain(self, capacity: int, shards: int, at_most: bool) -> list[int]:
        ends, end = [], 0
        for _ in range(shards):
            end = self.below(min(end + capacity, self.at[-1]), at_most)
            ends.append(end)
        return ends

    def least(self, shards: int, at_most: bool) -> int:
        """The smallest capacity whose greedy chain reaches the total."""
        lo, hi = 0, self.at[-1]
        while lo < hi:
            mid = (lo + hi) // 2
            if self.chain(mid, shards, at_most)[-1] >= self.at[-1]:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def unsure(self, lo: int, hi: int, shards: int) -> list[tuple[int, int]]:
        """Open stretches where a chain of a capacity from ``lo`` to ``hi`` can end."""
        found, first, last = set(), 0, 0
        for a, b in zip(self.chain(lo, shards, False), self.chain(hi, shards, True), strict=True):
            k, stop = bisect_right(self.at, first + lo) - 1, min(last + hi, self.at[-1])
            while k < len(self.open) and self.at[k] < stop:
                if self.open[k]:
                    found.add((self.at[k], self.at[k + 1]))
                k += 1
            first, last = a, b
        return sorted(found)

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Ends of the shards at known marks: none above the capacity, each as near to its equal share as can be."""
        total, need, latest = self.at[-1], self.at[-1], [self.at[-1]]
        for _ in range(shards - 1):  # from the back: where a shard must end at least
            need = self.at[bisect_left(self.at, max(need - capacity, 0))]
            latest.append(need)
        ends, end = [], 0
        for k, least in enumerate(latest[-2::-1] if shards > 1 else []):
            most = self.below(min(end + capacity, total), False)
            share = min(max(total * (k + 1) // shards, least), most)
            near = bisect_left(self.at, share)
            options = [v for v in self.at[max(near - 1, 0):near + 1] if max(least, end) <= v <= most] or [most]
            end = min(options, key=lambda v: (abs(v - share), v))
            ends.append(end)
        return [*ends, total]


def minimax_cuts(total: int, shards: int, split: Callable[[list[tuple[int, int]], int], dict]) -> tuple[int, list[int]]:
    """The smallest capacity and the shards' ends. ``split`` asks for marks: for stretches (lo, hi] cut into n parts
    it gives for each stretch the (first value, last value, number of values) of the parts that have any."""
    marks = Marks(total)
    ask, parts = [(0, total)], COARSE
    while ask:
        for (lo, hi), found in split(ask, parts).items():
            marks.add(lo, hi, found)
        lo, hi = marks.least(shards, True), marks.least(shards, False)
        ask, parts = marks.unsure(lo, hi, shards) if lo < hi else [], FINE
    return hi, marks.even_cuts(hi, shards)


def _splitter(sums: DataFrame) -> Callable:
    def split(stretches: list[tuple[int, int]], parts: int) -> dict:
        upto, which = F.col("upto"), None
        for lo, hi in stretches:
            part = F.floor((upto - lo - 1) / F.lit((hi - lo) / parts)).cast("long")
            hit, value = (upto > lo) & (upto <= hi), F.struct(F.lit(lo).cast("long").alias("lo"), part.alias("part"))
            which = F.when(hit, value) if which is None else which.when(hit, value)
        rows = sums.select(which.alias("w"), "upto").where("w is not null").groupBy("w").agg(
            F.min("upto").alias("first"), F.max("upto").alias("last"), F.count("*").alias("n")).collect()
        found: dict = {s: [] for s in stretches}
        ends = dict(stretches)
        for w, first, last, n in rows:
            found[w.lo, ends[w.lo]].append((first, last, n))
        return found
    return split


def assign_shards(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, size, text_crc32, shard, slot, and ``keep``) of all documents; slots follow the ids in a shard."""
    whole = F.coalesce(F.col(text), F.lit(""))
    extra = [F.col(c) for c in keep if c not in (id_column, "size", "text_crc32", "shard", "slot")]
    rows = materialize(docs.select(
        id_column, (F.octet_length(whole).cast("long") + 1).alias("size"), F.crc32(whole).alias("text_crc32"),
        F.xxhash64(whole).alias("_group"), *extra), "sized")
    # Two texts of one size, checksum and hash would only stay together, so no text has to be moved.
    key = ["_group", "size", "text_crc32"]
    groups = materialize(rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(id_column).alias("least")).withColumn(
        "bytes", F.col("size") * F.col("n")), "groups")
    left, alone = groups.agg(F.sum("bytes")).first()[0] or 0, []
    for g in groups.orderBy(F.desc("bytes"), *key).limit(shards - 1).collect():
        if g.bytes * (shards - len(alone)) <= left:
            break
        alone.append(g)
        left -= g.bytes
    is_alone = [(F.col("_group") == g._group) & (F.col("size") == g.size) & (F.col("text_crc32") == g.text_crc32) for g in alone]
    others = groups
    for hit in is_alone:
        others = others.where(~hit)
    sums = materialize(running_total(others.select(*key, "least", "bytes"), F.col("bytes"),
                                     [F.col("least"), *map(F.col, key)], "upto").select(*key, "upto"), "sums")
    _, cuts = minimax_cuts(left, shards - len(alone), _splitter(sums)) if left else (0, [])
    shard = F.lit(len(alone))
    for cut in cuts[:-1]:
        shard = shard + (F.col("upto") > cut).cast("int")
    placed = sums.select(*key, shard.cast("int").alias("shard"))
    own = F.lit(None).cast("int")
    for k, hit in enumerate(is_alone):
        own = F.when(hit, F.lit(k)).otherwise(own)
    # Groups with a shard of their own need no join, so no key with more than an equal share of the rows meets one.
    rows = rows.withColumn("_own", own)
    joined = rows.where("_own is not null").withColumnRenamed("_own", "shard").unionByName(
        rows.where("_own is null").drop("_own").join(placed, key))
    numbered = number_rows(joined, [F.col("shard"), F.col(id_column), F.col("_group")], "_number")
    before, bases = 0, F.lit(0)
    for s, n in sorted(joined.groupBy("shard").count().collect()):
        bases = F.when(F.col("shard") == s, F.lit(before)).otherwise(bases)
        before += n
    return numbered.select(id_column, "size", "text_crc32", "shard", (F.col("_number") - 1 - bases).cast("long").alias("slot"), *extra)


def op5(spark, sf_dir: str) -> DataFrame:
    found = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
