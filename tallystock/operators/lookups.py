"""Lookups and joins.

No side is broadcast by hint here: masters grow with the data, so Spark decides from the
sizes it sees at run time, and splits skewed partitions of the large side (adaptive skew
join). Only constant tables and one-row results are hinted or used as scalars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.operators.windows import first_per_key


def _first_match(table: DataFrame, key: str, returns: dict[str, str], order: list[Column] | None,
                 unique: bool) -> DataFrame:
    """Lookup side with one row per non-null key: the first in ``order``, or else the one with
    the lowest values to return. ``unique`` declares that keys do not repeat, which saves a window."""
    known = table.where(F.col(key).isNotNull())
    if not unique:
        # Dealt by key and its hash, the rows are dealt once more for the join: only then can
        # Spark split a hot key of the other side, as neither side holds a window any more.
        known = first_per_key(known.withColumn("_spread", F.xxhash64(key)), ["_spread", key],
                              order or [F.col(source) for source in returns])
    return known.select(F.col(key).alias("_lookup_key"), *[F.col(s).alias(t) for s, t in returns.items()])


def lookup_or_null(df: DataFrame, column: str, table: DataFrame, key: str, returns: dict[str, str],
                   order: list[Column] | None = None, unique: bool = False) -> DataFrame:
    """New columns from the first match, null where there is none."""
    side = _first_match(table, key, returns, order, unique)
    return df.join(side, F.col(column) == F.col("_lookup_key"), "left").drop("_lookup_key")


def lookup_keep_original(df: DataFrame, column: str, table: DataFrame, key: str, source: str, target: str,
                         order: list[Column] | None = None, unique: bool = False) -> DataFrame:
    """Typed id of the first match; the searched text goes to ``<target>_unmatched`` if none."""
    found = lookup_or_null(df, column, table, key, {source: target}, order, unique)
    return found.withColumn(f"{target}_unmatched", F.when(F.col(target).isNull(), F.col(column).cast("string")))


def lookup_in_place(df: DataFrame, column: str, table: DataFrame, key: str, source: str,
                    order: list[Column] | None = None, unique: bool = False) -> DataFrame:
    """Replace the column by the looked-up value, keep it where nothing matches."""
    found = lookup_or_null(df, column, table, key, {source: "_found"}, order, unique)
    return found.withColumn(column, F.coalesce("_found", column)).drop("_found")


def lookup_inner(df: DataFrame, column: str, table: DataFrame, key: str, returns: dict[str, str],
                 order: list[Column] | None = None, unique: bool = False) -> DataFrame:
    """Rows with a match only."""
    side = _first_match(table, key, returns, order, unique)
    return df.join(side, F.col(column) == F.col("_lookup_key"), "inner").drop("_lookup_key")


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    return left.join(right, keys, how)


def join_dimensions(fact: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Fact with its dimensions, one key each. Columns a fact already holds are not repeated."""
    for dimension, key in dimensions:
        extra = [c for c in dimension.columns if c == key or c not in fact.columns]
        fact = fact.join(dimension.select(*extra), key)
    return fact


def cross_singletons(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two one-row selections side by side, as scalar subqueries."""
    row = left.sparkSession.range(1, numPartitions=1)
    return row.select(*[side.select(c).scalar().alias(c) for side in (left, right) for c in side.columns])


def counts_per_key(df: DataFrame, key: str, conditions: dict[str, Column], base: DataFrame) -> DataFrame:
    """Conditional row counts per row of ``base``; 0 where no row has its key."""
    counts = df.groupBy(key).agg(*[F.count_if(p).alias(n) for n, p in conditions.items()])
    return base.join(counts, key, "left").fillna(0, list(conditions))
