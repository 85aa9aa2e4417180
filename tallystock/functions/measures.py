"""Aggregate expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(p: Column) -> Column:
    """Rows where ``p`` holds; null (not 0) on empty input, as SUM gives."""
    return F.sum(F.when(p, 1).otherwise(0))


def ratio_pct(part: Column, total: Column, digits: int = 2) -> Column:
    """part / total * 100 with exact decimal rounding; null when total is 0."""
    whole = F.nullif(total.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return F.round(part.cast("decimal(20,2)") * F.lit(100) / whole, digits)


def surplus(x: Column) -> Column:
    return F.sum(F.greatest(x, F.lit(0).cast("decimal(12,2)")))


def shortage(x: Column) -> Column:
    return F.abs(F.sum(F.least(x, F.lit(0).cast("decimal(12,2)"))))


def goal_mark(pct: Column, goal: int = 95) -> Column:
    return F.when(pct >= goal, "Cumple").otherwise("Bajo Meta")
