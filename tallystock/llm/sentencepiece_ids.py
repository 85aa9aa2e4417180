"""SentencePiece encoding and decoding by a streaming Viterbi search.

The public model is of the BPE kind, whose scores are merge ranks and no log-probabilities, so a search for the best sum
would give other ids than the model means. Instead a step from one piece to the next is allowed only if merging the two
pieces' characters gives just these two again. Then exactly one path of allowed steps reaches each place, and it is the
model's own encoding. The search keeps a back pointer for each place and a window of the last places that a piece can
still begin at, as many as the longest piece has characters. When all paths that survive in the window pass through
one boundary, the ids before it are committed and forgotten.

No piece joins a space to a character before it and none holds a line break, so all paths meet there; parts between such
places repeat a lot, and a worker keeps those it has seen up to CACHE_BYTES and drops them with its partition.

Defined cases: a null or empty text has no ids; characters that the model lacks become its byte pieces; the space sign of the
model (U+2581) in a text is decoded as a space; repeated rows are encoded alike; ids of documents may be null; an
empty table gives no rows; results replace columns of the same name, all other columns stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType

from tallystock.llm.ship import ship
from tallystock.llm.words import slices

CACHE_BYTES = 64 << 20  # of parts and their ids that a worker keeps
CACHE_STEPS = 200_000
_ENTRY_BYTES = 200  # what Python needs for a short string, its ids and their place in a dictionary, besides their own
INFINITY = float("inf")
SPACE = "▁"
_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A SentencePiece model's pieces, and encoding and decoding by them."""

    def __init__(self, path: str):
        from ahocorasick import Automaton
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        plain = [k for k in range(n) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        self.text = [model.id_to_piece(k) if not model.is_control(k) else "" for k in range(n)]
        self.ids = {self.text[k]: k for k in plain}
        self.rank = {self.text[k]: -model.get_score(k) for k in plain}  # pieces of lower rank are merged first
        # Pieces that share their rank, as runs of spaces do: which of two comes first hangs on where they stand.
        times = Counter(self.rank.values())
        self.tied = {piece for piece, rank in self.rank.items() if times[rank] > 1}
        self.byte = {int(self.text[k][3:5], 16): k for k in range(n) if model.is_byte(k)}
        self.raw = [text.encode() for text in self.text]
        for b, k in self.byte.items():
            self.raw[k] = bytes([b])
        self.longest = max(map(len, self.ids))
        self.ending = Automaton()
        for piece in self.ids:
            self.ending.add_word(piece, piece)
        self.ending.make_automaton()
        self.allowed: dict[tuple[str, str], bool] = {}
        self.grown: dict[str, tuple[list, list] | None] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cached = 0
        self.single = {c for c in self.ids if len(c) == 1}

    def drop_cache(self) -> None:
        self.cache, self.older, self.cached = {}, {}, 0

    def _merged(self, text: str) -> list[str]:
        """The characters of ``text`` merged by rank, the leftmost of equal ones first."""
        parts = list(text)
        while True:
            found = [(self.rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not found:
                return parts
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def _edges(self, piece: str) -> tuple[list, list] | None:
        """How the two ends of ``piece`` grow while its characters merge: (part, when it is made, when it is merged on), by rank,
        for its left and its right end. None if the characters do not merge to the piece."""
        if piece in self.grown:
            return self.grown[piece]
        parts, made = list(piece), [-INFINITY] * len(piece)
        left, right = [], []
        while len(parts) > 1:
            found = [(self.rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not found:
                break
            when, k = min(found)
            if when < max(made[k], made[k + 1]):
                raise ValueError("the model has a piece that is merged before its parts are")
            if k == 0:
                left.append((parts[0], made[0], when))
            if k + 2 == len(parts):
                right.append((parts[-1], made[-1], when))
            parts[k:k + 2], made[k:k + 2] = [parts[k] + parts[k + 1]], [when]
        whole = (piece, made[0], INFINITY)
        self.grown[piece] = ([*left, whole], [*right, whole]) if len(parts) == 1 else None
        return self.grown[piece]

    def _step(self, before: str, piece: str) -> bool:
        """Whether the characters of both merge to just these two: no merge across their border comes before those inside."""
        known = self.allowed.get((before, piece))
        if known is None:
            if len(self.allowed) >= CACHE_STEPS:
                self.allowed.clear()
            plain = before in self.tied or piece in self.tied
            after, ahead = (None, None) if plain else (self._edges(piece), self._edges(before) if before else ([], []))
            known = after is not None and ahead is not None
            if plain:
                known = self._merged(before + piece) == ([before, piece] if before else [piece])
            elif known:
                rank = self.rank
                for y, made_y, gone_y in after[0]:
                    for x, made_x, gone_x in ahead[1]:
                        when = rank.get(x + y)
                        # Of two equal merges the left one comes first, so y loses against its right neighbour and x does not.
                        if when is not None and when < gone_x and when <= gone_y and made_x < gone_y and made_y < gone_x:
                            known = False
                            break
                    if not known:
                        break
            self.allowed[before, piece] = known
        return known

    def _ids_of(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.byte[b] for b in piece.encode()]

    def search(self, text: str) -> list[int]:
        """Ids of a text whose spaces are written as the model's sign."""
        if len(text) <= 4 * self.longest and self.single.issuperset(text):
            return self._search_window(text)
        ids: list[int] = []
        pointer: dict[int, str] = {0: ""}  # the piece that ends at a place, on the path to it
        committed = at = 0
        longest, allowed = self.longest, self.allowed
        for last, piece in self.ending.iter(text):
            end = last + 1
            if end != at:
                self._lone(pointer, text, at, end - 1)
                if at - committed > 4 * longest:  # look for the boundary that the paths of the window share
                    committed = self._commit(pointer, committed, at - longest + 1, at, ids)
                at = end
            if end in pointer:
                continue
            before = pointer.get(end - len(piece))
            if before is not None:
                step = allowed.get((before, piece))
                if step or step is None and self._step(before, piece):
                    pointer[end] = piece
        self._lone(pointer, text, at, len(text))
        self._commit(pointer, committed, len(text), len(text), ids)
        return ids

    def _search_window(self, text: str) -> list[int]:
        """The search over a text no longer than the window, all of whose characters are pieces."""
        pointer: list[str | None] = [None] * (len(text) + 1)
        pointer[0] = ""
        allowed = self.allowed
        for last, piece in self.ending.iter(text):
            if pointer[last + 1] is None:
                before = pointer[last + 1 - len(piece)]
                if before is not None:
                    step = allowed.get((before, piece))
                    if step or step is None and self._step(before, piece):
                        pointer[last + 1] = piece
        ids, end = [], len(text)
        while end:
            piece = pointer[end]
            ids.append(self.ids[piece])
            end -= len(piece)
        ids.reverse()
        return ids

    @staticmethod
    def _lone(pointer: dict[int, str], text: str, at: int, upto: int) -> None:
        """Characters that no piece ends with stand alone."""
        for end in range(at, upto + 1):
            if end not in pointer and end - 1 in pointer:
                pointer[end] = text[end - 1]

    def _commit(self, pointer: dict[int, str], committed: int, first: int, last: int, ids: list[int]) -> int:
        """Emit the ids up to the last boundary that the paths to all places from ``first`` to ``last`` share."""
        shared: list[int] | None = None
        for place in range(first, last + 1):
            if place not in pointer:
                continue
            ends = []
            while place > committed:
                ends.append(place)
                place -= len(pointer[place])
            ends.reverse()
            shared = ends if shared is None else [a for a, b in zip(shared, ends, strict=False) if a == b]
        for end in shared or []:
            ids += self._ids_of(pointer[end])
            committed = end
        for place in [p for p in pointer if p < committed and p < first]:
            del pointer[place]
        return committed

    def _part(self, part: str) -> bytes:
        found = self.cache.get(part)
        if found is None:
            found = self.older.get(part)
            if found is None:
                line = part[:1] == "\n"
                ids = self._ids_of("\n") * line + self.search(part[1:] if line else SPACE + part)
                found = pack(f"<{len(ids)}I", *ids)
            self.cached += _ENTRY_BYTES + len(part) + len(found)
            if 2 * self.cached > CACHE_BYTES:  # parts that come again move on to the new half
                self.older, self.cache, self.cached = self.cache, {}, 0
            self.cache[part] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if not text:
            return b""
        parts = text.replace("\n", " \n").split(" ")
        if "" in parts or SPACE in text or text[0] == "\n" or "\n" in self.ids:
            ids = [k for part in _PARTS.findall(SPACE + text.replace(" ", SPACE)) for k in self.search(part)]
            return np.array(ids, "<u4").tobytes()
        known = self.cache.get
        found = [known(p) for p in parts]
        if None in found:
            found = [self._part(p) if ids is None else ids for p, ids in zip(parts, found, strict=True)]
        return b"".join(found)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no text become U+FFFD."""
        text = b"".join([self.raw[k] for k in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _with_pass(docs: DataFrame, text: str, path: str, keep: list[str], results: dict[str, tuple[DataType, Callable]]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with results (type, function of text and ids as bytes), in one pass over the texts."""
    schema = StructType([*(docs.schema[c] for c in keep), *(StructField(name, kind) for name, (kind, _) in results.items())])
    arrow, at, places = to_arrow_schema(schema), docs.columns.index(text), [docs.columns.index(c) for c in keep]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = pieces(path)
        for batch in batches:
            for first, part in slices(batch.column(at)):
                columns: list[list] = [[] for _ in results]
                for own in part:
                    value = own.as_py()
                    ids = search.encode(value)
                    for column, (_, f) in zip(columns, results.values(), strict=True):
                        column.append(f(search, value, ids))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(first, len(part)) for k in places),
                     *(pa.array(c, arrow.field(name).type) for c, name in zip(columns, results, strict=True))], schema=arrow)
        search.drop_cache()
    return docs.mapInArrow(rows, schema)


def encode(docs: DataFrame, text: str = "text", model: str | None = None, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of every text."""
    docs = docs.drop(name)
    return _with_pass(docs, text, model or default_model(), docs.columns, {
        name: (ArrayType(IntegerType()), lambda _, __, ids: np.frombuffer(ids, "<i4"))})


def check(docs: DataFrame, text: str = "text", model: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if none are named) with n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers) and round_trip, whether the ids decode to the text again."""
    results = ["n_tokens", "ids_crc32", "round_trip"]
    return _with_pass(docs, text, model or default_model(), [c for c in keep or docs.columns if c not in results], {
        "n_tokens": (LongType(), lambda _, __, ids: len(ids) // 4), "ids_crc32": (LongType(), lambda _, __, ids: zlib.crc32(ids)),
        "round_trip": (BooleanType(), lambda search, value, ids: search.decode(np.frombuffer(ids, "<i4").tolist()) == (value or ""))})


def decode(docs: DataFrame, ids: str = "ids", model: str | None = None, name: str = "decoded") -> DataFrame:
    """``docs`` with the text of every row's ids; null ids have an empty text."""
    path = model or default_model()
    docs = docs.drop(name)
    at, schema = docs.columns.index(ids), StructType([*docs.schema.fields, StructField(name, StringType())])
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = pieces(path)
        for batch in batches:
            texts = [search.decode(x.as_py() or []) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=arrow)
    return docs.mapInArrow(rows, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return check(docs, keep=["doc_id"])
