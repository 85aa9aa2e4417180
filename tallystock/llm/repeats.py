"""Which 64-bit hashes occur more than once in the corpus, found without a row per hash.

Rows are dealt into chunks of bounded size. A chunk sends its distinct hashes, sorted and cut by their top
bits into buckets, as delta-coded blobs of 5 to 6 bytes a hash; a bucket's task finds the hashes that
occur again and sends each chunk only its own. A hash of a very common passage comes once per chunk.
"""

from __future__ import annotations

import math


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
BUCKET_HASHES = 1 << 20
HASH_ROWS = "bucket int, chunk long, hashes binary, counts binary"
REPEAT_ROWS = "chunk long, hashes binary, counts binary"


def chunk_of(df: DataFrame, text: str, identity: list[str]) -> tuple[Column, int]:
    """The chunk of a row, about CHUNK_BYTES of text each, and the number of buckets for their hashes."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    buckets = 1 << max(4, math.ceil(math.log2(max(1, total / 5 / BUCKET_HASHES))))
    return F.pmod(F.xxhash64(*identity), F.lit(chunks)).alias("_chunk"), buckets


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Differences of ascending hashes by byte plane: the high planes are zeros, which the shuffle's codec drops."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def hash_rows(chunk: int, hashes: np.ndarray, buckets: int) -> pa.Table:
    """The rows that a chunk sends: its distinct hashes and how often each occurs in it."""
    known, counts = np.unique(hashes, return_counts=True)
    shift = np.uint64(64 - int(math.log2(buckets)))
    bucket = (known >> shift).astype(np.int64)
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = list(zip(bucket[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(known)], strict=True)) if len(known) else []
    counts = np.minimum(counts, np.iinfo(np.uint32).max).astype("<u4")
    return pa.table({
        "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
        "chunk": pa.array([chunk] * len(rows), pa.int64()),
        "hashes": pa.array([pack(known[lo:hi]) for _, lo, hi in rows], pa.binary()),
        "counts": pa.array([counts[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()),
    })


def _repeats_of_bucket(bucket: pa.Table) -> pa.Table:
    chunks = bucket["chunk"].to_numpy()
    parts = [unpack(b.as_py()) for b in bucket["hashes"]]
    sizes = np.array([len(p) for p in parts], np.int64)
    hashes = np.concatenate(parts)
    del parts
    counts = np.frombuffer(b"".join(b.as_py() for b in bucket["counts"]), "<u4").astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    total = np.add.reduceat(counts[order], heads)
    totals = np.empty(len(hashes), np.int64)
    totals[order] = np.repeat(total, np.diff(np.append(heads, len(hashes))))
    again = totals > 1
    ends = np.cumsum(sizes)
    out = []
    for chunk, lo, hi in zip(chunks, ends - sizes, ends, strict=True):
        if (mask := again[lo:hi]).any():
            out.append((chunk, pack(hashes[lo:hi][mask]), totals[lo:hi][mask].astype("<i8").tobytes()))
    return pa.table({
        "chunk": pa.array([x[0] for x in out], pa.int64()),
        "hashes": pa.array([x[1] for x in out], pa.binary()),
        "counts": pa.array([x[2] for x in out], pa.binary()),
    })


def repeated(rows: DataFrame) -> DataFrame:
    """Rows of ``hash_rows`` to rows (chunk, hashes, counts) of the hashes that occur twice or more in all."""
    return rows.groupBy("bucket").applyInArrow(_repeats_of_bucket, REPEAT_ROWS)


def known_repeats(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's repeated hashes, ascending, with their counts in the whole corpus."""
    found = [(unpack(h), c) for h, c in zip(side["hashes"].to_pylist(), side["counts"].to_pylist(), strict=True) if h]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.concatenate([h for h, _ in found])
    counts = np.concatenate([np.frombuffer(c, "<i8") for _, c in found])
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def lookup(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is in the ascending array ``known``, and where."""
    if not len(known):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes, at


