"""Registered queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from tallystock.catalog.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, so that two engines give equal values."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, oracle: str | None = None) -> Callable:
    """Register ``f(inputs) -> DataFrame`` under ``name`` with its DuckDB SQL."""
    def register(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: comparable(f(Inputs(spark, sf_dir)))
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return f

    return register


def pct(part: str, total: str) -> str:
    """DuckDB text of part / total * 100, rounded half up to two places in whole numbers."""
    a, b = f"CAST(({part}) AS HUGEINT)", f"CAST(({total}) AS HUGEINT)"
    return f"(CAST(({a} * 20000 + {b}) // nullif(2 * {b}, 0) AS DOUBLE) / 100)"
