"""Grouped and global aggregates used by reports and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.functions.cells import clean_code
from tallystock.functions.measures import ratio_pct
from tallystock.operators.filters import row_kind


def dedupe_by_key(df: DataFrame, keys: str | list[str], order: list[Column] | None = None) -> DataFrame:
    """One whole row per key: the first in ``order``, ties by a hash of the row, then by its columns.

    An aggregate of whole rows: tasks reduce their rows to one per key before the shuffle, so a key that a third of all rows
    share costs one row per task. Null is a key like any other; without an order, the row of least hash stays. Columns have to be
    of types that can be compared (no maps).
    """
    keys = [keys] if isinstance(keys, str) else keys
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order or [])], F.xxhash64(row).alias("h"), row.alias("r"))
    kept = df.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, place).alias("_row"))
    return kept.select("_row.*")


def distinct_values(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Distinct values of several columns and where each was first seen, from one scan.

    Each row is folded into its values before the shuffle, so what travels is the lists.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in columns]))
    exploded = df.select(order, pairs.alias("_pair")).select(order, "_pair.*")
    return exploded.groupBy("columna", "valor").agg(F.min(order).alias("primera_fila"))


def coverage_gate(sheet: DataFrame, key: str, minimum: int = 80) -> DataFrame:
    """Share of data rows with a code per file, and a warning below the minimum."""
    data = sheet.where(row_kind("principal") == "dato")
    counted = data.groupBy(key).agg(
        F.count("*").alias("total"), F.count(clean_code(F.col("codigo_raw"))).alias("con_codigo"))
    pct = ratio_pct(F.col("con_codigo"), F.col("total"))
    exact = F.col("con_codigo") * 100 < F.col("total") * minimum
    return counted.withColumns({"pct_codigo": pct, "estado": F.when(exact, "WARNING").otherwise("OK")})


def detail_plus_total(detail: DataFrame, base: DataFrame, label: str, total_label: str, keys: dict[str, Column],
                      sums: list[str], derived: dict[str, Column]) -> DataFrame:
    """Grouped rows plus total rows over ``base``, the rows before any dimension was joined.

    ``keys`` that are columns of ``base`` give a total row each; constant ones give one row,
    with zeros where ``base`` has no rows.
    """
    grouped = [k for k, v in keys.items() if k in base.columns and v is None]
    totals = base.groupBy(*grouped).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    total = totals.select(*[(F.col(k) if k in grouped else v).alias(k) for k, v in keys.items()], *sums,
                          F.lit(total_label).alias(label))
    return detail.unionByName(total).withColumns(derived)


def version_stats(dimension: DataFrame, name: str) -> DataFrame:
    """Total, active and historical versions of a dimension."""
    active = F.col("es_registro_activo")
    return dimension.agg(
        F.lit(name).alias("nombre_dimension"),
        F.count("*").alias("total_registros"),
        F.count_if(active).alias("registros_activos"),
        F.count_if(~active).alias("registros_hist"),
    )
