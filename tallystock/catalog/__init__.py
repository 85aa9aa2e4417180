"""Every operator as a registered query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallystock.catalog.registry import ORACLES, QUERIES

_GROUPS = ["sources", "file_runs", "columns", "joins", "aggregates", "scalars", "quality", "warehouse", "reports"]


def _load() -> None:
    for group in _GROUPS:
        import_module(f"tallystock.catalog.{group}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
