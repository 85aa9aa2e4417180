"""Benchmark decontamination by generalised suffix automata of the items' words.

Words are runs of ASCII letters and digits, lowered, and of all characters beyond ASCII. An automaton holds every run of words of
a group of items; a document's words are streamed through it, and at each word it gives the length of the longest run of
item words that ends there. A run is a leak if it is as long as the length limit, or as the coverage limit's share of an item that
holds it (with 1.0: an item shorter than the length limit counts as a whole). Words of leaks are hit; the items that hold them are
listed, and the spans can be cut from the text. Only stretches whose neighbouring words are neighbours in some item are
streamed, since no run can leave them.

Items are cut into pieces of bounded size that overlap by less than the limit, equal pieces are one, and pieces are
dealt into groups by size, one automaton each, built in Spark tasks. The automaton that is broadcast is
therefore bounded, however large the benchmark is; with several groups the documents are read once for each. Documents are
never shuffled.

Defined cases: a null or empty text has no words and no hits (a null stays null when cut); an item without words is in no
document; items of equal text are all listed, rows of one item id once, rows without an id hit words but are not listed; repeated
documents are read one by one; an empty table of documents gives no rows, one of items no hits; results
replace columns of the same name, all other columns stay.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallystock.llm.repeats import lookup
from tallystock.llm.ship import ship
from tallystock.llm.words import Words, slices, words
from tallystock.session import materialize

GROUP_BYTES = 4 << 20  # of item text in one automaton
PIECE_WORDS = 50_000
_PLAIN = np.full(256, 32, np.uint8)  # what is no letter becomes a space, so that words are runs between spaces
for _low, _high in ((48, 58), (97, 123), (128, 256)):
    _PLAIN[_low:_high] = np.arange(_low, _high)
_PLAIN[65:91] = np.arange(97, 123)


def item_words(texts: pa.Array) -> Words:
    """The lowered words of each row; places are those of the text itself, as no byte is added or lost."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_PLAIN[data]))
    return words(plain)


class Automaton:
    """Suffix automaton of several sequences of small numbers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, after: dict[int, int], link: int, length: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A state for the runs of ``child`` that are no longer than those of ``parent`` and one word."""
        copy = self._state(dict(self.next[child]), self.link[child], self.length[parent] + 1)
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            there = self.next[last].get(word)
            if there is not None:
                last = there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
                continue
            new = self._state({}, 0, self.length[last] + 1)
            at = last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                child = self.next[at][word]
                self.link[new] = child if self.length[child] == self.length[at] + 1 else self._split(at, word, child)
            last = new

    def mark(self, sequences: list[list[int]], needs: list[int]) -> dict[int, list[int]]:
        """Of each state the sequences that hold its longest run, if that is as long as the sequence's need."""
        held: dict[int, list[int]] = {}
        for number, (sequence, need) in enumerate(zip(sequences, needs, strict=True)):
            seen: set[int] = set()
            state = 0
            for word in sequence:
                state = at = self.next[state][word]
                while self.length[at] >= need and at not in seen:
                    seen.add(at)
                    held.setdefault(at, []).append(number)
                    at = self.link[at]
        return held


def build(bodies: list[str], needs: list[int], ids: list[list[str]]) -> bytes:
    """The automaton of one group as arrays: vocabulary, pairs of neighbours, transitions, links, lengths, what each state reports."""
    found = item_words(pa.array(bodies, pa.large_string()))
    vocabulary, tokens = np.unique(found.hash, return_inverse=True)
    cuts = found.first.tolist()
    sequences = [tokens[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
    automaton = Automaton()
    for sequence in sequences:
        automaton.add(sequence)
    held = automaton.mark(sequences, needs)
    size = len(vocabulary)
    neighbours = np.unique(np.array([a * size + b for s in sequences for a, b in zip(s, s[1:], strict=False)], np.int64))
    keys = np.array([state * size + word for state, after in enumerate(automaton.next) for word in after], np.int64)
    to = np.array([t for after in automaton.next for t in after.values()], np.int32)
    return pickle.dumps({
        "vocabulary": vocabulary, "neighbours": neighbours, "keys": keys, "to": to, "held": held, "needs": needs, "ids": ids,
        "link": np.array(automaton.link, np.int32), "length": np.array(automaton.length, np.int32)})


class Reader:
    """Streams texts through a built automaton."""

    def __init__(self, blob: bytes):
        a = pickle.loads(blob)
        self.vocabulary, self.neighbours = a["vocabulary"], a["neighbours"]
        self.after = dict(zip(a["keys"].tolist(), a["to"].tolist(), strict=True))
        self.link, self.length = a["link"].tolist(), a["length"].tolist()
        self.held, self.needs, self.ids = a["held"], a["needs"], a["ids"]
        self.least = min(self.needs, default=0)
        need_of = {s: min(self.needs[n] for n in own) for s, own in self.held.items()}
        self.need = [need_of.get(s, 1 << 60) for s in range(len(self.link))]
        self.reach = [-1] * len(self.link)  # the longest run of a state or its suffixes that some sequence needs no longer
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.reach[s] = self.length[s] if s in self.held else self.reach[self.link[s]] if s else 0

    def stretches(self, found: Words) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Word numbers in the vocabulary, and the runs of words (start, end) that a leak can lie in."""
        n = len(found.start)
        known, number = lookup(self.vocabulary, found.hash)
        if not n or not len(self.vocabulary):
            return number, []
        joined = np.zeros(n, bool)  # whether a word continues the one before it
        pairs = known[1:] & known[:-1]
        at = np.flatnonzero(pairs) + 1
        value = number[at - 1] * len(self.vocabulary) + number[at]
        place = np.minimum(np.searchsorted(self.neighbours, value), max(0, len(self.neighbours) - 1))
        joined[at] = self.neighbours[place] == value if len(self.neighbours) else False
        joined[found.first[:-1][found.first[:-1] < n]] = False
        heads = np.flatnonzero(~joined)
        ends = np.append(heads[1:], n)
        good = (ends - heads >= self.least) & known[heads]
        return number, list(zip(heads[good].tolist(), ends[good].tolist(), strict=True))

    def leaks(self, numbers: list[int], first: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
        """The leaks (start, end) in a stretch, one for each word that ends one, and the states that report items
        with the longest run read there."""
        after, link, length, need, reach = self.after, self.link, self.length, self.need, self.reach
        size, least = len(self.vocabulary), self.least
        spans, states = [], {}
        state = run = 0
        for end, word in enumerate(numbers, first + 1):
            to = after.get(state * size + word)
            while to is None and state:
                state = link[state]
                run = length[state]
                to = after.get(state * size + word)
            if to is None:
                continue
            state = to
            run += 1
            if run < least:
                continue
            hit = run if need[state] <= run else reach[link[state]]
            if hit > 0:
                spans.append((end - hit, end))
                if states.get(state, 0) < run:
                    states[state] = run
        return spans, states

    def items(self, states: dict[int, int]) -> set[int]:
        """Sequences that hold a leak which ends in one of the states."""
        out: set[int] = set()
        seen: set[int] = set()
        for state, run in states.items():
            out.update(n for n in self.held.get(state, ()) if self.needs[n] <= run)
            at = self.link[state]
            while at > 0 and at not in seen and self.reach[at] > 0:
                seen.add(at)
                out.update(self.held.get(at, ()))
                at = self.link[at]
        return out


def _pieces(length: int, coverage: float) -> Callable:
    """Item rows (id, text) to rows (id, need, body) of bounded size: every run of ``need`` words lies in one piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                found = item_words(part)
                ids = batch.column(0).slice(first, len(part)).to_pylist()
                out = []
                for row, own in enumerate(ids):
                    lo, hi = int(found.first[row]), int(found.first[row + 1])
                    need = max(1, min(length, math.ceil(coverage * (hi - lo))))
                    for at in range(lo, max(lo + 1, hi - need + 1) if hi > lo else lo, PIECE_WORDS):
                        out.append((own, need, " ".join(map(found.text, range(at, min(hi, at + PIECE_WORDS + need - 1))))))
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[2] for x in out], pa.string())], ["id", "need", "body"])
    return cut


def _build_group(key: tuple, rows: pa.Table) -> pa.Table:
    blob = build(rows["body"].to_pylist(), rows["need"].to_pylist(), rows["ids"].to_pylist())
    return pa.table({"group": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([blob], pa.binary())})


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text", length: int = 10, coverage: float = 1.0,
             group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows (group, automaton) of a benchmark, stored."""
    whole = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    pieces = whole.mapInArrow(_pieces(length, coverage), "id string, need int, body string")
    bodies = materialize(pieces.groupBy("body", "need").agg(F.collect_set("id").alias("ids")), "item-pieces")
    total = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    dealt = bodies.withColumn("group", F.pmod(F.xxhash64("body"), F.lit(groups)).cast("int"))
    return materialize(dealt.groupBy("group").applyInArrow(_build_group, "group int, automaton binary"), "automata")


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as disjoint ones, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(automaton: Broadcast | None, at: int, keep: list[int], again: bool, cut: str | None, schema: StructType) -> Callable:
    """One reading of the texts in column ``at``; with ``again`` the last two columns hold what was found before."""
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(automaton.value) if automaton is not None else None
        for batch in batches:
            for first, part in slices(batch.column(at)):
                found = item_words(part)
                before = [c.slice(first, len(part)).to_pylist() for c in batch.columns[-2:]] if again else [[[]] * len(part)] * 2
                spans: dict[int, list[tuple[int, int]]] = {}
                states: dict[int, dict[int, int]] = {}
                numbers, stretches = reader.stretches(found) if reader else (None, [])
                heads = [a for a, _ in stretches]
                for (a, b), row in zip(stretches, (np.searchsorted(found.first, heads, "right") - 1).tolist(), strict=True):
                    own, ends = reader.leaks(numbers[a:b].tolist(), a - int(found.first[row]))
                    if own:
                        spans.setdefault(row, []).extend(own)
                        known = states.setdefault(row, {})
                        for state, run in ends.items():
                            known[state] = max(run, known.get(state, 0))
                hit_words, hit_items, n_hit, clean = [], [], [], []
                for row in range(len(part)):
                    own = _union([*spans.get(row, []), *zip(before[0][row][::2], before[0][row][1::2], strict=True)])
                    listed = {i for n in (reader.items(states[row]) if row in states else ()) for i in reader.ids[n]}
                    hit_words.append([x for span in own for x in span])
                    hit_items.append(sorted({*listed, *before[1][row]}))
                    n_hit.append(sum(b - a for a, b in own))
                    if cut:
                        clean.append(_without(part[row].as_py(), own, found, row) if own else part[row].as_py())
                size = len(part)
                sides = [pa.array(np.diff(found.first), pa.int64()), pa.array(n_hit, pa.int64())] if not again else [
                    *(c.slice(first, size) for c in batch.columns[-4:-3]), pa.array(n_hit, pa.int64())]
                columns = [batch.column(k).slice(first, size) for k in keep]
                if cut:
                    columns.append(pa.array(clean, pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, *sides, pa.array(hit_words, pa.list_(pa.int64())),
                                                  pa.array(hit_items, pa.list_(pa.string()))], schema=arrow)
    return rows


def _without(text: str, spans: list[tuple[int, int]], found: Words, row: int) -> str:
    raw = text.encode()
    base, first = int(found.offsets[row]), int(found.first[row])
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:int(found.start[first + a]) - base])
        at = int(found.end[first + b - 1]) - base
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, built: DataFrame, text: str = "text", keep: list[str] | None = None, cut: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if none are named) with n_words, n_hit, hit_words (places of the first and, exclusive,
    the last word of each leak) and hit_items, by the ``automata`` of a benchmark. ``cut`` names a column for the text without
    the leaks."""
    results = ["n_words", "n_hit", "hit_words", "hit_items", *([cut] if cut else [])]
    keep = [c for c in keep or docs.columns if c not in results]
    context = docs.sparkSession.sparkContext
    groups = [row[0] for row in built.select("group").orderBy("group").collect()]
    read = "_text"
    while read in keep:
        read = "_" + read
    now, again = docs.select(*keep, F.col(text).alias(read)), False
    for number in groups or [None]:
        last = number is None or number == groups[-1]
        blob = context.broadcast(built.where(F.col("group") == number).first().automaton) if number is not None else None
        carried = keep if last else [*keep, read]
        fields = [now.schema[c] for c in carried]
        if last and cut:
            fields.append(StructField(cut, StringType()))
        schema = StructType([*fields, StructField("n_words", LongType()), StructField("n_hit", LongType()),
                             StructField("hit_words", ArrayType(LongType())), StructField("hit_items", ArrayType(StringType()))])
        places = [now.columns.index(c) for c in carried]
        now = now.mapInArrow(_scan(blob, now.columns.index(read), places, again, cut if last else None, schema), schema)
        again = True
        if not last:
            now = materialize(now, "leaks")
    return now


def op11(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    built = automata(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = decontaminate(docs, built, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS run
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM i WHERE len(w) > 0)
), found AS MATERIALIZED (
  SELECT r, p, n, item_id
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n) s
  JOIN windows USING (n) WHERE run = array_to_string(w[p:p + n - 1], ' ')
), hits AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(p, p + n - 1)) AS place FROM found) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN listed USING (r)
"""
