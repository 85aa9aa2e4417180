"""Global sorts and existence probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.session import materialize


def sort_rows(df: DataFrame, *order: Column, copies: bool = False) -> DataFrame:
    """Global sort in which rows that tie can still be sorted by many tasks.

    A hash of the whole row is the last sort key, so the range shuffle can cut through a
    value that a third of all rows share. It is the same on every attempt of a task. Where
    whole rows repeat (``copies``) their hashes tie too; rows are then stored first and
    numbered in place, which a lost executor cannot change any more.
    """
    if copies:
        stored = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "unsorted")
        return stored.orderBy(*order, "_tie").drop("_tie")
    return df.withColumn("_tie", F.xxhash64(*df.columns)).orderBy(*order, "_tie").drop("_tie")


def any_row(df: DataFrame, name: str) -> DataFrame:
    """One row that tells whether ``df`` has any; the scan stops at the first."""
    return df.limit(1).agg((F.count("*") > 0).alias(name))
