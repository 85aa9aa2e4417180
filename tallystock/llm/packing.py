"""Best-fit packing of token pieces into sequences by hierarchical residual packing.

Pieces are dealt into leaves of about LEAF_ITEMS items. A leaf packs best-fit, longest first, and its nearly full
bins are done. Its other bins are items of the next round: nodes of FAN leaves pack whole bins best-fit, and so
on up the tree. After best-fit a node has at most one bin that is half full or less, so a later node has at
most FAN bins that can still move, and FAN bins of each fill level are enough for it to choose from. A node thus
hands on at most FAN bins a level, whatever its size, without losing a fit; the others are done as they are.

Defined cases: a null or empty text is the end id alone; a text longer than the capacity is cut into full pieces from its
end, so that only its first piece may be shorter; a null length counts as 0; repeated rows are packed each for
itself; an id may be null or repeated; an empty table gives no rows. ``pack`` keeps all columns of its input;
results replace columns of the same name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallystock.llm.ship import ship
from tallystock.llm.token_ids import default_tokenizer, encoder
from tallystock.llm.words import slices
from tallystock.session import materialize

CAPACITY, END_ID = 1024, 2
LEAF_ITEMS, FAN = 16_384, 8
NEARLY_FULL = 8  # free places that are not worth another round
_BROADCAST_MOVES = 1_000_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def token_pieces(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True, added: bool = False) -> DataFrame:
    """Rows (id, piece, start, length, and ids or their ids_crc32) for every document."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start long, length long, " + ("ids array<int>" if ids else "ids_crc32 long")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path, added)
        encode = library.encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first, part in slices(batch.column(1)):
                at, piece, start, length, value = [], [], [], [], []
                for row, found in enumerate(encode(part.to_pylist())):
                    found += end
                    for k, (s, n) in enumerate(cut(len(found) // 4, capacity)):
                        own = found[4 * s:4 * (s + n)]
                        at.append(first + row)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        value.append(np.frombuffer(own, "<i4") if ids else zlib.crc32(own))
                columns = [batch.column(0).take(pa.array(at, pa.int64())), piece, start, length, value]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow)
        library.drop_cache()  # the worker may serve other work after this partition
    return docs.select(id_column, text).mapInArrow(rows, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each item, and the fill of each bin: longest first, each into the fullest bin that it fits."""
    bins, places, fills = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free places
    mask = 0  # bit r: a bin with r free places is open
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        fitting = mask >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[item], places[item] = b, fills[b]
        fills[b] += n
        if room > n:
            free[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, places, np.array(fills, np.int64)


def _leaf_packer(capacity: int) -> Callable:
    def pack_leaf(key: tuple, items: pa.Table) -> pa.Table:
        bins, places, fills = best_fit(items["_length"].to_numpy(), capacity)
        ids = (np.int64(key[0].as_py()) << 32) + bins
        return items.append_column("_bin", pa.array(ids)).append_column("_place", pa.array(places)).append_column(
            "_fill", pa.array(fills[bins]))
    return pack_leaf


def _node_packer(capacity: int, fan: int) -> Callable:
    def pack_node(key: tuple, items: pa.Table) -> pa.Table:
        order = np.argsort(items["_bin"].to_numpy())
        own, lengths = items["_bin"].to_numpy()[order], items["_fill"].to_numpy()[order]
        bins, places, fills = best_fit(lengths, capacity)
        heads = np.flatnonzero(places == 0)
        target = np.zeros(len(fills), np.int64)
        target[bins[heads]] = own[heads]
        handed = np.zeros(capacity + 1, np.int64)
        out = []
        for bin_, fill in zip(target.tolist(), fills.tolist(), strict=True):
            if fill < capacity - NEARLY_FULL and handed[fill] < fan:
                handed[fill] += 1
                out.append((bin_, None, 0, fill))
        moved = np.flatnonzero(places > 0)
        out += zip(own[moved].tolist(), target[bins[moved]].tolist(), places[moved].tolist(), [0] * len(moved))
        node = key[0].as_py() // fan
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array([node] * len(out), pa.int64()), *(pa.array(list(c), pa.int64()) for c in columns)],
                        ["_node", "_bin", "_target", "_shift", "_fill"])
    return pack_node


def _merge_tree(bins: DataFrame, leaves: int, capacity: int, fan: int) -> DataFrame | None:
    """Moves (_bin, _target, _shift) of whole bins; ``bins``: (_node, _bin, _fill) with _node = leaf // fan."""
    rounds = []
    nodes = math.ceil(leaves / fan)
    open_bins = bins
    while True:
        done = materialize(open_bins.groupBy("_node").applyInArrow(
            _node_packer(capacity, fan), "_node long, _bin long, _target long, _shift long, _fill long"), "round")
        rounds.append(done.where("_target is not null").select("_bin", "_target", "_shift"))
        if nodes == 1:
            break
        nodes = math.ceil(nodes / fan)
        open_bins = done.where("_target is null").select("_node", "_bin", "_fill")
    moves = rounds.pop()
    for earlier in reversed(rounds):  # a bin that others moved into may have moved itself
        later = moves.select(F.col("_bin").alias("_target"), F.col("_target").alias("_end"), F.col("_shift").alias("_more"))
        through = earlier.join(later, "_target", "left").select(
            "_bin", F.coalesce("_end", "_target").alias("_target"),
            (F.col("_shift") + F.coalesce("_more", F.lit(0))).alias("_shift"))
        moves = through.unionAll(moves)
    return moves


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, leaf_items: int = LEAF_ITEMS,
         fan: int = FAN) -> DataFrame:
    """``pieces`` with sequence_id and offset; lengths above the capacity are an error."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    stored = materialize(pieces.select(
        *names, F.coalesce(F.col(length).cast("long"), F.lit(0)).alias("_length"),
        F.monotonically_increasing_id().alias("_row")), "pieces")
    n, longest = stored.agg(F.count(F.when(F.col("_length") < capacity, 1)), F.max("_length")).first()
    if longest is not None and longest > capacity:
        raise ValueError(f"a piece of {longest} does not fit into {capacity}")
    full = stored.where(F.col("_length") == capacity).select(
        *names, (F.col("_row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    leaves = max(1, math.ceil(n / leaf_items))
    leaf = F.pmod(F.xxhash64("_row"), F.lit(leaves)).alias("_leaf")
    items = stored.where(F.col("_length") < capacity).select("*", leaf)
    added = StructType.fromDDL("_bin long, _place long, _fill long")
    schema = StructType([*items.schema.fields, *added.fields])
    placed = materialize(items.groupBy("_leaf").applyInArrow(_leaf_packer(capacity), schema), "placed")
    if leaves > 1:
        bins = placed.where(F.col("_fill").between(1, capacity - NEARLY_FULL - 1)).groupBy("_bin").agg(
            F.first("_fill").alias("_fill")).select(F.floor(F.shiftright("_bin", 32) / fan).alias("_node"), "_bin", "_fill")
        moves = _merge_tree(bins, leaves, capacity, fan)
        # At most one bin a leaf moves.
        placed = placed.join(F.broadcast(moves) if leaves <= _BROADCAST_MOVES else moves, "_bin", "left")
    else:
        placed = placed.withColumn("_target", F.lit(None).cast("long")).withColumn("_shift", F.lit(0).cast("long"))
    return full.unionByName(placed.select(
        *names, (F.coalesce("_target", "_bin") * 2).alias("sequence_id"),
        (F.col("_place") + F.coalesce("_shift", F.lit(0))).alias("offset")))


def op2(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(token_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids=False, added=True))
