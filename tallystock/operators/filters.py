"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.functions import cells

ROW_CELLS = {
    "principal": ["codigo_raw", "nombre_raw", "fisico_raw", "sistema_raw"],
    "lotes": ["codigo_raw", "nombre_raw", "fisico_raw", "sistema_raw"],
    "catalogo": ["codigo_raw", "descripcion_raw"],
    "movimientos": ["tipo_raw", "fecha_raw"],
}


def empty_row(kind: str) -> Column:
    """All cells that matter are empty. Cells come trimmed, with null for empty, from the scan."""
    return F.coalesce(*[F.col(c) for c in ROW_CELLS[kind]]).isNull()


def header_row(kind: str) -> Column:
    if kind == "movimientos":
        return F.coalesce(F.lower("tipo_raw") == "tipo", F.lit(False))
    return cells.is_header_word(F.col("codigo_raw"))


def row_kind(kind: str) -> Column:
    """vacia, encabezado, seccion or dato, tested in this order."""
    chain = F.when(empty_row(kind), "vacia").when(header_row(kind), "encabezado")
    if kind == "principal":
        chain = chain.when(cells.section_name(F.col("codigo_raw")).isNotNull(), "seccion")
    return chain.otherwise("dato")


def drop_empty_rows(df: DataFrame, kind: str) -> DataFrame:
    return df.where(~empty_row(kind))


def drop_header_rows(df: DataFrame, kind: str) -> DataFrame:
    return df.where(~header_row(kind))


def keep_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def remove_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Drop the listed values; null is not a listed value and stays."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(values))


def remove_empty_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def date_range_filter(df: DataFrame, column: str, first: str, before: str) -> DataFrame:
    """Half-open range: first <= date < before."""
    c = F.col(column)
    return df.where((c >= F.lit(first).cast("date")) & (c < F.lit(before).cast("date")))


def active_between(df: DataFrame, low: int = 0, high: int = 365) -> DataFrame:
    """Active versions with an expiry date within the given number of days."""
    return df.where(F.col("es_registro_activo") & F.col("fecha_vencimiento").isNotNull()
                    & F.col("dias_para_vencer").between(low, high))


def snapshot_filter(fact: DataFrame, sk_tiempo: int) -> DataFrame:
    """One count. On a fact written by count date this reads one folder only, also where the folder is a copy of the key."""
    if "toma" in fact.columns:
        fact = fact.where(F.col("toma") == sk_tiempo).drop("toma")
    return fact.where(F.col("sk_tiempo") == sk_tiempo)


def positive_stock_filter(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("cantidad_fisica") > 0)
