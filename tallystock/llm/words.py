"""Words of whole texts as arrays: places, rows and 64-bit hashes, computed for a batch at once.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are polynomial (Rabin-Karp) over 64-bit
values, taken from running sums, so that any span of a sequence costs one subtraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WORD_BASE, _SEQUENCE_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLICE_BYTES = 1 << 19
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_BASE))


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, _SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:n]


class Rolling:
    """Hashes of spans of ``values`` that depend on the span's values and length alone."""

    def __init__(self, values: np.ndarray, base: int = _SEQUENCE_BASE):
        self.inverse = pow(base, -1, 1 << 64)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers_of(base, len(values)), out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(start) == 0:
            return np.zeros(0, np.uint64)
        back = _powers_of(self.inverse, int(start.max()) + 1)[start]
        return mix((self.sums[end] - self.sums[start]) * back + (end - start).astype(np.uint64))


@dataclass
class Words:
    """``start`` and ``end`` are byte places in ``data``; ``first[r]`` to ``first[r + 1]`` are row r's words."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``width`` words inside one row."""
        n = np.diff(self.first)
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.first[1:], n) - width
        at = np.flatnonzero(np.arange(len(self.start)) <= last)
        return at, Rolling(self.hash).spans(at, at + width)

    def text(self, word: int) -> str:
        return self.data[self.start[word]:self.end[word]].tobytes().decode()


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each row; a null text has none. ``lower``: A-Z are lowered first."""
    texts = pc.fill_null(texts, "")
    size = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], size)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside, cut = ~_SPACE[data], np.zeros(n + 1, bool)
    cut[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (before | cut[:-1]))
    end = np.flatnonzero(inside & (after | cut[1:])) + 1
    hashes = Rolling(_BYTE[data], _WORD_BASE).spans(start, end)
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), hashes)


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, pa.Array]]:
    """First row and rows of pieces of about 512 KB; a longer text comes alone and whole."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + _SLICE_BYTES, "right")))
        yield at, texts.slice(at, to - at)
        at = to


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every run, one run after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
