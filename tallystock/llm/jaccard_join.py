"""N-gram Jaccard join by prefixes under several global orders of the shingles.

A text's set holds its distinct runs of ``width`` words (A-Z lowered); two texts link when
100 * intersection >= percent * union. Texts with equal sets form one class, and one text stands for it.

An order ranks all shingles by how many classes hold them, rarest first; ties fall differently in each order.
Two linked sets of sizes n share a shingle among the first n - ceil(n * percent / 100) + 1 of both, in every
order, so a shingle that no other class holds finds nothing and is never sent. Candidates meet on a prefix
shingle of the first order, must then share one in each further order, and are verified on whole sets.

Groups of thousands of near copies are not paired off. In a few rounds every class is tried against one hub of
the shingle that it shares most, which joins a group in about as many pairs as it has members. Then all
remaining pairs that share a prefix shingle and are in different components are tried, so no link between
components is lost: for a shingle of up to SHORT_LIST classes as pairs; classes that meet on more common shingles
are dealt in blocks, and a task counts the overlaps of two blocks at once and returns links alone.

Defined cases: null, empty and blank texts have empty sets, link with nothing and are components of their own; fewer
than ``width`` words give one shingle, the whole sequence; repeated rows and ids share a class when their
sets are equal; a null id is never a component's name unless all its ids are null; empty tables give no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystock.llm.components import connected
from tallystock.llm.repeats import HASH_ROWS, chunk_of, hash_rows, known_repeats, lookup, repeated
from tallystock.llm.ship import ship
from tallystock.llm.words import Rolling, mix, slices, words
from tallystock.session import materialize

ORDERS = 3
HUB_ROUNDS = 2
SHORT_LIST = 32
BLOCK_CLASSES, BLOCK_GRAMS = 1024, 1 << 20
_MEMBERS = "id {id}, _chunk long, n_shingles long, node binary"
_CLASSES = "node binary, n int, held double, tokens array<long>, places array<int>, {orders}, grams array<long>"


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    w = words(texts, lower=True)
    at, hashes = w.windows(width)
    edges = np.searchsorted(at, w.first)
    sequence = Rolling(w.hash)
    for k, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
        if b - a >= width:
            yield np.unique(hashes[edges[k]:edges[k + 1]])
        else:
            yield sequence.spans(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _member_rows(width: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for _, part in slices(batch.column(2)):
                for grams in shingle_sets(part, width):
                    sizes.append(len(grams))
                    nodes.append(_digest(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary())],
                ["id", "_chunk", "n_shingles", "node"])
    return rows


def _class_sets(docs: pa.Table, side: pa.Table, width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """The sets of the classes that this chunk stands for, each once."""
    wanted = {x for nodes in side["nodes"].to_pylist() if nodes for x in nodes}
    for _, part in slices(docs["text"]):
        for grams in shingle_sets(part, width):
            if len(grams) and (node := _digest(grams)) in wanted:
                wanted.remove(node)
                yield node, grams


def _sender(width: int, buckets: int) -> Callable:
    def send(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        found = [grams for _, grams in _class_sets(docs, side, width)]
        return hash_rows(key[0].as_py(), np.concatenate(found) if found else np.zeros(0, np.uint64), buckets)
    return send


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def _class_rows(width: int, percent: int, orders: int) -> Callable:
    def rows(docs: pa.Table, side: pa.Table) -> pa.Table:
        known, held_by = known_repeats(side)
        nodes, sizes, held_most, columns = [], [], [], [[] for _ in range(2 + orders)]
        for node, grams in _class_sets(docs, side, width):
            again, at = lookup(known, grams)
            classes = np.where(again, held_by[at], 1) if len(known) else np.ones(len(grams), np.int64)
            first = prefix_size(len(grams), percent)
            if (classes == 1).sum() >= first:
                continue  # no shingle of any prefix is held by another class
            for k in range(orders):
                ties = grams if k == 0 else mix(grams ^ np.uint64(k))
                prefix = np.lexsort((ties, classes))[:first]
                shared = np.flatnonzero(classes[prefix] > 1)
                held = grams[prefix[shared]]
                if k == 0:
                    columns[0].append(held.view(np.int64))
                    columns[1].append(shared.astype(np.int32))
                else:
                    columns[1 + k].append((held >> np.uint64(32)).astype(np.uint32).view(np.int32))
            columns[1 + orders].append(grams.view(np.int64))
            nodes.append(node)
            sizes.append(len(grams))
            held_most.append(float(np.log2(classes).mean()))
        kinds = [pa.int64(), *[pa.int32()] * orders, pa.int64()]
        return pa.table(
            [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(held_most, pa.float64()),
             *[_ragged(c, kind) for c, kind in zip(columns, kinds, strict=True)]],
            ["node", "n", "held", "tokens", "places", *[f"order{k}" for k in range(1, orders)], "grams"])
    return rows


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many values each array of ``a`` shares with each of ``b`` (values of one array differ)."""
    found = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    row_a, row_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    (in_a, at_a), (in_b, at_b) = lookup(shared, flat_a), lookup(shared, flat_b)
    row_a, at_a, row_b, at_b = row_a[in_a], at_a[in_a], row_b[in_b], at_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
    for lo in range(0, len(shared), 4096):
        width = min(4096, len(shared) - lo)
        (a0, a1), (b0, b1) = np.searchsorted(at_a, [lo, lo + width]), np.searchsorted(at_b, [lo, lo + width])
        left, right = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        left[row_a[a0:a1], at_a[a0:a1] - lo] = 1
        right[row_b[b0:b1], at_b[b0:b1] - lo] = 1
        found += left @ right.T
    return found.astype(np.int64)


def _block_verifier(percent: int, orders: list[str]) -> Callable:
    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block = rows["block"].to_numpy()
        sides = [np.flatnonzero(block == i), np.flatnonzero(block == j)]
        if not all(len(s) for s in sides):
            return pa.table({"x": pa.array([], pa.binary()), "y": pa.array([], pa.binary())})

        def arrays(name: str) -> list[list[np.ndarray]]:
            whole = rows[name].combine_chunks()
            return [[whole[k].values.to_numpy() for k in side] for side in sides]
        names = np.array(rows["component"].to_pylist(), object)
        _, component = np.unique(names, return_inverse=True)
        may = component[sides[0]][:, None] != component[sides[1]][None, :]
        for order in orders:  # a prefix shingle must be shared in every order
            if not may.any():
                break
            may &= _overlaps(*arrays(order)) > 0
        x, y = np.nonzero(may)
        if len(x):
            a, b = arrays("grams")
            used_a, used_b = np.unique(x), np.unique(y)
            both = _overlaps([a[k] for k in used_a], [b[k] for k in used_b])
            both = both[np.searchsorted(used_a, x), np.searchsorted(used_b, y)]
            size_a, size_b = np.array([len(s) for s in a]), np.array([len(s) for s in b])
            linked = both * 100 >= (size_a[x] + size_b[y] - both) * percent
            x, y = x[linked], y[linked]
        x, y = sides[0][x], sides[1][y]
        # One link for two components is enough here.
        pair = np.minimum(component[x], component[y]) * len(block) + np.maximum(component[x], component[y])
        _, first = np.unique(pair, return_index=True)
        nodes = rows["node"].combine_chunks()
        return pa.table({"x": nodes.take(pa.array(x[first])), "y": nodes.take(pa.array(y[first]))})
    return verify


class _Links:
    """Candidate pairs of classes and their verification."""

    def __init__(self, classes: DataFrame, percent: int, orders: int):
        self.classes, self.percent = classes, percent
        self.orders = [f"order{k}" for k in range(1, orders)]
        entry = F.explode(F.arrays_zip("tokens", "places"))
        self.postings = classes.select("node", "n", "held", entry.alias("e")).select(
            F.col("e.tokens").alias("token"), "node", "n", "held", F.col("e.places").alias("place"))

    def _sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def _placed(self, components: DataFrame | None) -> DataFrame:
        if components is None:
            return self.postings.withColumn("component", F.col("node"))
        own = components.select(F.col("node"), F.col("component"))
        return self.postings.join(own, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def hub_pairs(self, components: DataFrame | None, turn: int) -> DataFrame:
        """Each class with the hub, outside its component, that it meets on most shingles.

        The first turn's hub of a shingle is the class whose shingles are most common: it was changed least.
        """
        entries = self._placed(components)
        rank = -F.col("held") if turn == 0 else F.xxhash64("node", F.lit(turn))
        hubs = entries.groupBy("token").agg(F.min(F.struct(
            rank.alias("h"), F.col("node").alias("x"), F.col("n").alias("nx"),
            F.col("component").alias("cx"))).alias("hub"))
        met = entries.join(hubs, "token").where(
            (F.col("component") != F.col("hub.cx")) & self._sizes_fit(F.col("n"), F.col("hub.nx")))
        counted = met.groupBy("node", F.col("hub.x").alias("x")).agg(F.count("*").alias("c"))
        best = counted.groupBy("node").agg(F.max(F.struct("c", "x")).alias("b"))
        return best.select(F.col("b.x").alias("x"), F.col("node").alias("y"))

    def remaining(self, components: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What is left between components: pairs (x, y) to verify, and links (x, y) found in blocks."""
        entries = self._placed(components)
        mixed = materialize(entries.groupBy("token").agg(
            F.count("*").alias("m"), F.min("component").alias("a"), F.max("component").alias("b"),
            F.min("node").alias("hub")).where("a <> b").select("token", "m", "hub"), "mixed")
        left = materialize(entries.drop("held").join(mixed, "token"), "entries")
        return self._short_list_pairs(left.where(F.col("m") <= SHORT_LIST)), self._block_links(
            left.where(F.col("m") > SHORT_LIST), components)

    def _short_list_pairs(self, left: DataFrame) -> DataFrame:
        right = left.select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "place", "component")])
        needed = F.ceil((F.col("n") + F.col("n2")) * self.percent / (100 + self.percent))
        reach = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
        return left.join(right, "token").where(
            (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2"))
            & self._sizes_fit(F.col("n"), F.col("n2")) & (reach >= needed)
        ).select(F.col("node").alias("x"), F.col("node2").alias("y")).distinct()

    def _block_links(self, left: DataFrame, components: DataFrame) -> DataFrame:
        """Links among the classes that common shingles connect, block against block."""
        groups = connected(left.select(F.col("hub").alias("x"), F.col("node").alias("y")))
        rows = groups.select("node", F.col("component").alias("gid")).join(self.classes, "node").join(
            components, "node", "left").withColumn("component", F.coalesce("component", "node"))
        sizes = groups.select("node", F.col("component").alias("gid")).join(
            self.classes.select("node", "n"), "node").groupBy("gid").agg(F.ceil(F.greatest(
                F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
        rows = rows.join(sizes, "gid").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "gid", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node",
            "component", "tokens", *self.orders, "grams")
        return dealt.groupBy("gid", "i", "j").applyInArrow(
            _block_verifier(self.percent, ["tokens", *self.orders]), "x binary, y binary")

    def _with(self, pairs: DataFrame, columns: list[str]) -> DataFrame:
        for side in ("x", "y"):
            own = self.classes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            pairs = pairs.join(own, side)
        return pairs

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that share a prefix shingle in every further order and whose sets are similar enough."""
        kept = self._with(pairs, self.orders)
        for order in self.orders:
            kept = kept.where(F.arrays_overlap(f"{order}_x", f"{order}_y"))
        whole = self._with(kept.select("x", "y"), ["grams"])
        both = F.size(F.array_intersect("grams_x", "grams_y"))
        union = F.size("grams_x") + F.size("grams_y") - both
        return whole.where(both * 100 >= union * self.percent).select("x", "y")


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75,
                 orders: int = ORDERS, hub_rounds: int = HUB_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Members (id, n_shingles, node, component_id) of all rows of ``docs``, and the verified links (x, y) of nodes.

    The links join every component; of the links inside one, those needed to join it are listed.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    chunk, buckets = chunk_of(own, "text", ["id", "text"])
    dealt = own.select("text", chunk)
    members = materialize(own.select("id", chunk, "text").mapInArrow(
        _member_rows(width), _MEMBERS.format(id=own.schema["id"].dataType.simpleString())), "members")
    stands = members.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "_chunk")).alias("s"), F.min("id").alias("least_id"))
    stands = materialize(stands.select("node", "least_id", "s._chunk"), "classes")
    nodes = stands.groupBy(F.col("_chunk").alias("chunk")).agg(F.collect_list("node").alias("nodes"))

    sent = dealt.groupBy("_chunk").cogroup(nodes.groupBy("chunk")).applyInArrow(_sender(width, buckets), HASH_ROWS)
    side = nodes.unionByName(repeated(sent), allowMissingColumns=True)
    names = ", ".join(f"order{k} array<int>" for k in range(1, orders))
    classes = materialize(dealt.groupBy("_chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        _class_rows(width, percent, orders), _CLASSES.format(orders=names)), "prefixes")

    join = _Links(classes, percent, orders)
    links = spark.createDataFrame([], "x binary, y binary")
    tried = links
    components = None
    for turn in range(max(1, hub_rounds) + 1):
        last = turn == max(1, hub_rounds)
        pairs, found = join.remaining(components) if last else (join.hub_pairs(components, turn), None)
        unordered = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        pairs = materialize(unordered.distinct().join(tried, ["x", "y"], "left_anti"), "pairs")
        tried = tried.unionAll(pairs)
        verified = join.verified(pairs)
        links = links.unionAll(materialize(verified if found is None else verified.unionAll(found), "links"))
        components = connected(links)
    named = stands.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    found = members.drop("_chunk").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", "n_shingles", "node", component.alias("component_id")), links


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``docs`` begins with it."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the text of the smallest id stays, in one row.

    Rows whose text has no words stay, all of them.
    """
    key, copy = (unused(docs, name) for name in ("_key", "_copy"))
    # Rows of one id may lie in several groups, so a row is known by its id and text.
    whole = docs.withColumn(key, F.struct(F.col(id_column).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash")))
    members, _ = jaccard_join(whole, key, text)
    chosen = members.where(F.col("node").isNull() | F.col("id").eqNullSafe(F.col("component_id"))).groupBy(F.col("id").alias("_id")).agg(
        F.bool_or(F.col("node").isNull()).alias("_empty"))
    stay = whole.join(chosen.select(F.col("_id").alias(key + "_"), F.col("_empty").alias(copy + "_")), F.col(key).eqNullSafe(F.col(key + "_")))
    copies = Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns))
    return stay.withColumn(copy, F.row_number().over(copies)).where(F.col(copy + "_") | (F.col(copy) == 1)).select(*docs.columns)


def op10(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    members, _ = jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return members.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g
  FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), both_hold AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM both_hold JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = r
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
