"""Token ids in files, compressed by a grammar: frequent pairs of ids become nonterminals, block by block (Re-Pair).

Documents are range-partitioned by id, and each partition cuts its ids into blocks of about BLOCK_IDS, never inside a
document. In a block, rounds replace all pairs that occur MIN_PAIRS times or more, from left to right and never across
the end of a document, until a round saves little. A block keeps its rules, the number of ids that each rule stands for, the symbols, and how many
symbols and ids each document has, so one document, or a stretch of one, is read without expanding others.
Blocks are rows of a Parquet table in the given folder, so that Spark commits, retries and reads them.

Block layout, little-endian: ``RPG1``; 6 unsigned 32-bit numbers (terminals below, rules, documents, symbols, ids, rounds);
then unsigned 32-bit arrays: rules of each round, left and right symbol of each rule, ids that each rule stands for,
symbols of each document, ids of each document, symbols.

Defined cases: a null or empty text is the end id alone; null document ids come first; repeated ids are written in order
of their texts; other columns of the input are not read; an empty table makes an empty file and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallystock.llm.ship import ship
from tallystock.llm.token_ids import default_tokenizer, encoder
from tallystock.llm.words import ragged, slices
from tallystock.session import new_path

END_ID = 0
BLOCK_IDS, MIN_PAIRS, MAX_ROUNDS = 1 << 18, 8, 8
MIN_GAIN = 0.01
_SLOT_BITS = 16
_MAGIC = b"RPG1"


@dataclass
class Grammar:
    """A compressed block. Symbols from ``base`` on are rules; ``rounds`` counts the rules that each round made."""

    base: int
    rounds: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    doc_symbols: np.ndarray
    doc_ids: np.ndarray
    symbols: np.ndarray

    def to_bytes(self) -> bytes:
        arrays = (self.rounds, self.left, self.right, self.size, self.doc_symbols, self.doc_ids, self.symbols)
        head = [self.base, len(self.left), len(self.doc_ids), len(self.symbols), self.doc_ids.sum(), len(self.rounds)]
        return _MAGIC + np.array(head, "<u4").tobytes() + b"".join(a.astype("<u4").tobytes() for a in arrays)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Grammar:
        if blob[:4] != _MAGIC:
            raise ValueError("this is no grammar block")
        base, rules, docs, symbols, _, rounds = np.frombuffer(blob, "<u4", 6, 4).tolist()
        arrays, at = [], 28
        for n in (rounds, rules, rules, rules, docs, docs, symbols):
            arrays.append(np.frombuffer(blob, "<u4", n, at).astype(np.int64))
            at += 4 * n
        return cls(base, *arrays)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that ``symbols`` stand for."""
        bounds = self.base + np.concatenate([[0], np.cumsum(self.rounds)])
        used, place = np.unique(symbols, return_inverse=True)
        flat = used
        for lo in bounds[:-1][::-1]:  # rules of a round hold symbols of earlier rounds only
            rule = flat >= lo
            if rule.any():
                start = np.cumsum(1 + rule) - (1 + rule)
                out = np.empty(len(flat) + rule.sum(), np.int64)
                out[start] = np.where(rule, self.left[np.maximum(flat - self.base, 0)], flat) if len(self.left) else flat
                out[start[rule] + 1] = self.right[flat[rule] - self.base]
                flat = out
        size = self._sizes(used)
        begin = np.cumsum(size) - size
        return flat[ragged(begin[place], size[place])].astype("<u4")

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        if not len(self.size):
            return np.ones(len(symbols), np.int64)
        return np.where(symbols >= self.base, self.size[np.maximum(symbols - self.base, 0)], 1)

    def document(self, k: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``end`` of document ``k``; only the symbols that hold them are expanded."""
        first = int(self.doc_symbols[:k].sum())
        symbols = self.symbols[first:first + int(self.doc_symbols[k])]
        end = int(self.doc_ids[k]) if end is None else min(end, int(self.doc_ids[k]))
        upto = np.cumsum(self._sizes(symbols))
        lo, hi = np.searchsorted(upto, start, "right"), np.searchsorted(upto, end, "left") + 1
        skipped = int(upto[lo - 1]) if lo else 0
        return self.expand(symbols[lo:hi])[start - skipped:max(end, start) - skipped]


def compress(ids: np.ndarray, doc_ids: np.ndarray, min_pairs: int = MIN_PAIRS, max_rounds: int = MAX_ROUNDS) -> Grammar:
    """The grammar of ``ids``, which are those of documents of ``doc_ids`` ids each (1 or more)."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(doc_ids) - 1] = True
    base = int(symbols.max(initial=0)) + 1
    left, right, size, rounds = [], [], [], []
    sizes = np.ones(base, np.int64)
    while len(rounds) < max_rounds and len(symbols) > 1:
        # Neighbours as one 64-bit number; the place of a pair in the tables is its hash.
        pair = symbols[:-1].astype(np.uint64) << np.uint64(32)
        pair |= symbols[1:]
        slot = ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.uint16)
        open_ = np.flatnonzero(~last[:-1])
        open_slot, open_pair = slot[open_], pair[open_]
        holder = np.zeros(1 << _SLOT_BITS, np.uint64)
        holder[open_slot] = open_pair  # a pair hidden by another one in its slot waits for a later round
        own = holder[open_slot] == open_pair
        open_, open_slot = open_[own], open_slot[own]
        counts = np.bincount(open_slot, minlength=1 << _SLOT_BITS)
        found = np.flatnonzero(counts >= min_pairs)
        if not len(found):
            break
        found = found[np.lexsort((holder[found], -counts[found]))]
        rule = np.zeros(1 << _SLOT_BITS, np.uint32)
        rule[found] = np.arange(len(found)) + len(sizes)
        new = rule[open_slot]
        at, new = open_[new > 0], new[new > 0]
        heads = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of runs of overlapping pairs: every other one is taken
        run_start = np.repeat(at[heads], np.diff(np.append(heads, len(at))))
        taken = (at - run_start) % 2 == 0
        at = at[taken]
        pairs = holder[found]
        left.append((pairs >> np.uint64(32)).astype(np.int64))
        right.append((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64))
        size.append(sizes[left[-1]] + sizes[right[-1]])
        sizes = np.concatenate([sizes, size[-1]])
        rounds.append(len(found))
        symbols[at] = new[taken]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        before = len(symbols)
        symbols, last = symbols[keep], last[keep]
        if before - len(symbols) < MIN_GAIN * before:
            break  # another round would save even less
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    doc_symbols = np.diff(np.flatnonzero(last), prepend=-1)
    return Grammar(base, np.array(rounds, np.int64), joined(left), joined(right), joined(size), doc_symbols,
                   np.asarray(doc_ids, np.int64), symbols.astype(np.int64))


def write_token_files(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text",
                      tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                      added: bool = False) -> None:
    """Write the ids of all documents, in ascending order of their id, below ``path``."""
    model = tokenizer or default_tokenizer()
    kind = docs.schema[id_column].dataType.simpleString()
    schema = StructType.fromDDL(f"part int, block int, docs array<{kind}>, n_ids long, grammar binary")
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, end = encoder(model, added).encode, np.array([end_id], "<u4").tobytes()
        part, block = TaskContext.get().partitionId(), 0
        keys, found, n = [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(f) // 4 for f in found], np.int64)
            grammar = compress(np.frombuffer(b"".join(found), "<u4"), sizes).to_bytes()
            return pa.RecordBatch.from_pydict({"part": [part], "block": [block], "docs": [list(keys)], "n_ids": [n],
                                               "grammar": [grammar]}, schema=arrow)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                names = batch.column(0).slice(first, len(texts)).to_pylist()
                for name, ids in zip(names, encode(texts.to_pylist()), strict=True):
                    keys.append(name)
                    found.append(ids + end)
                    n += len(found[-1]) // 4
                    if n >= block_ids:
                        yield flush()
                        keys, found, n, block = [], [], 0, block + 1
        if keys:
            yield flush()
    ordered = docs.select(id_column, text).repartitionByRange(F.col(id_column), F.xxhash64(text)).sortWithinPartitions(
        id_column, text)
    ordered.mapInArrow(rows, schema).write.option("compression", "zstd").parquet(path)


def _block_starts(files: DataFrame) -> DataFrame:
    """Rows (part, block, first): the ids before each block. First parts are added up, then the blocks of each."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = files.select("part", "block", F.coalesce(inside, F.lit(0)).alias("_inside"))
    return blocks.join(parts, "part").select("part", "block", (F.col("_before") + F.col("_inside")).alias("first"))


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id", ids: bool = True) -> DataFrame:
    """Rows (id, start, n_tokens, and ids or their ids_crc32) of every document, from the files alone."""
    files = spark.read.parquet(path)
    kind = files.schema["docs"].dataType.elementType.simpleString()
    schema = StructType.fromDDL(
        f"`{id_column}` {kind}, start long, n_tokens long, " + ("ids array<int>" if ids else "ids_crc32 long"))
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                grammar = Grammar.from_bytes(batch.column(1)[k].as_py())
                found = grammar.expand(grammar.symbols)
                ends = np.cumsum(grammar.doc_ids)
                starts = ends - grammar.doc_ids
                own = [found[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                value = [o.view("<i4") for o in own] if ids else [zlib.crc32(o.tobytes()) for o in own]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[k].values, pa.array(starts + batch.column(2)[k].as_py()), pa.array(grammar.doc_ids),
                    pa.array(value, arrow.field(3).type)], schema=arrow)
    # One small row a block: Spark sends them to the grammars while they are few.
    starts = _block_starts(files.select("part", "block", "n_ids"))
    return files.join(starts, ["part", "block"]).select("docs", "grammar", "first").mapInArrow(rows, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    path = new_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, added=True)
    return read_token_files(spark, path, ids=False)
