"""Column list operators: keep, remove, rename, reorder, add, replace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame


def _require(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def remove_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; unlike plain ``drop`` a missing one is an error."""
    _require(df, names)
    return df.drop(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    _require(df, list(names))
    return df.withColumnsRenamed(names)


def reorder_columns(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Move columns: each rule is (column, column it goes after), applied in order."""
    names = list(df.columns)
    for column, after in rules:
        _require(df, [column, after])
        names.remove(column)
        names.insert(names.index(after) + 1, column)
    return df.select(*names)


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns one after the other; later ones may read earlier ones.

    A name that is taken already gets the first free numbered suffix.
    """
    for name, value in columns.items():
        free, n = name, 1
        while free in df.columns:
            n += 1
            free = f"{name} {n}"
        df = df.withColumn(free, value)
    return df


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    _require(df, list(columns))
    return df.withColumns(columns)


def derive_branches(df: DataFrame, branches: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Several tables from one. The branches stay lazy and share the plan of ``df``."""
    return {name: branch(df) for name, branch in branches.items()}
