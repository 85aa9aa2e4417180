"""Embedding columns as arrays of whole numbers, and as matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there and holds neither a null nor a number that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def floored(vector: str, scale: int) -> Column:
    """Every component x as the whole number floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def extent(vectors: DataFrame, products_below: int, v: str = "v") -> tuple[int, int]:
    """Number of rows and longest vector; raises where a product of two vectors could reach ``products_below``."""
    n, width, low, high = vectors.agg(
        F.count("*"), F.max(F.size(v)), F.min(F.array_min(v)), F.max(F.array_max(v))).first()
    largest = max(-(low or 0), high or 0)
    if (width or 0) * largest * largest >= products_below:
        raise ValueError(f"components up to {largest} in {width} dimensions are too large for exact whole-number products")
    return n, width or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers as floats, shorter ones filled with zeros; exact below 2**53."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    if len(column):
        out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
    return out
