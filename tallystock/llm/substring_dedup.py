"""Substring dedup: Rabin-Karp hashes of every window of words, counted over the corpus.

Every run of ``width`` consecutive words of one text is hashed. Hashes that occur twice or more, in the same
text or another, mark their words; marked words join into maximal intervals, which go. The input alone
decides: windows that removal creates are not looked at.

Defined cases: a null or blank text, or one of fewer than ``width`` words, has nothing to remove and an empty
``removed``; repeated rows are copies of each other and lose their common passages; null ids are rows like
any other; an empty table gives no rows. All columns of the input stay, except that results
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallystock.llm.repeats import (
    HASH_ROWS, chunk_of, hash_rows, known_repeats, lookup, repeated)
from tallystock.llm.ship import ship
from tallystock.llm.words import Words, ragged, slices, words

ADDED = "n_words long, n_removed long, removed array<struct<first:int,end:int>>, kept string"


def _sender(width: int, buckets: int, text: str) -> Callable:
    def send(key: tuple, docs: pa.Table) -> pa.Table:
        hashes = [words(part).windows(width)[1] for _, part in slices(docs[text])]
        return hash_rows(key[0].as_py(), np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), buckets)
    return send


def marked_words(first: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which words a window that starts at one of ``starts`` covers; ``first[-1]`` words in all."""
    steps = np.zeros(first[-1] + 1, np.int64)
    steps[starts] += 1
    steps[starts + width] -= 1
    return np.cumsum(steps)[:-1] > 0


def _intervals(marked: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _without(w: Words, mask: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The texts without the marked words and the white space behind them, and where each row's begin."""
    behind = np.append(w.start[1:], len(w.data))
    row_end = np.repeat(w.offsets[1:], np.diff(w.first))
    steps = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(steps, w.start[mask], 1)
    np.add.at(steps, np.minimum(behind, row_end)[mask], -1)
    stay = np.cumsum(steps[:-1]) == 0
    return w.data[stay].tobytes(), np.concatenate([[0], np.cumsum(stay)])[w.offsets]


def _remover(width: int, text: str, fields: pa.Schema, layout: bool) -> Callable:
    def remove(docs: pa.Table, side: pa.Table) -> pa.Table:
        known, _ = known_repeats(side)
        n_words, n_removed, removed, kept = [], [], [], []
        for _, part in slices(docs[text]):
            w = words(part)
            at, hashes = w.windows(width)
            mask = marked_words(w.first, at[lookup(known, hashes)[0]], width)
            if layout:
                out, begin = _without(w, mask)
                kept += [out[a:b].decode() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            # Kept words with one space after each, copied byte by byte in one gather.
            size = w.end - w.start
            stay = np.flatnonzero(~mask)
            length = size[stay] + 1
            data = np.append(w.data, np.uint8(32))
            places = ragged(w.start[stay], length)
            places[np.cumsum(length) - 1] = len(w.data)
            joined = data[places].tobytes()
            ends = np.concatenate([[0], np.cumsum(length)])
            below = np.concatenate([[0], np.cumsum(~mask)])
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                own = mask[a:b]
                n_words.append(b - a)
                n_removed.append(int(own.sum()))
                removed.append(_intervals(own) if n_removed[-1] else [])
                if not layout:
                    kept.append(joined[ends[below[a]]:max(ends[below[a]], ends[below[b]] - 1)].decode())
        columns = [docs[name] for name in fields.names[:-4]]
        added = [pa.array(v, fields.field(i - 4).type) for i, v in enumerate((n_words, n_removed, removed, kept))]
        return pa.table([*columns, *added], schema=fields)
    return remove


def substring_dedup(docs: DataFrame, text: str = "text", width: int = 35, layout: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed, removed (word intervals) and kept: the remaining words with one space between,
    or with ``layout`` the text with its own white space, but for what stood behind a removed word."""
    docs = docs.drop("n_words", "n_removed", "removed", "kept", "_chunk")
    chunk, buckets = chunk_of(docs, text, docs.columns)
    dealt = docs.select("*", chunk)
    sent = dealt.groupBy("_chunk").applyInArrow(_sender(width, buckets, text), HASH_ROWS)
    side = repeated(sent)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(ADDED).fields])
    remover = _remover(width, text, to_arrow_schema(schema), layout)
    return dealt.groupBy("_chunk").cogroup(side.groupBy("chunk")).applyInArrow(remover, schema)


def op9(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS seq
  FROM w, unnest(range(1, greatest(len(words) - 33, 1))) AS t(i)
), marked AS (
  SELECT doc_id, unnest(range(i, i + 35)) AS k
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY seq) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM marked GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN words ELSE
         list_transform(list_filter(range(1, len(words) + 1), lambda x: NOT list_contains(ks, x)), lambda x: words[x]) END, ' '))
       AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
