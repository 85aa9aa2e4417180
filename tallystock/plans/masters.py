"""Classified products, masters and the product master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.functions import rules
from tallystock.operators.aggregates import distinct_values
from tallystock.operators.columns import add_columns
from tallystock.operators.windows import number_rows
from tallystock.session import materialize


def classify_products(staging: DataFrame, code: str = "codigo_raw", name: str = "nombre_raw",
                      section: str = "categoria_raw") -> DataFrame:
    """Category, review mark, brand, unit and presentation of each staging row."""
    return add_columns(staging, {
        "categoria_jerarquizada": rules.classify_category(F.col(name), F.col(section)),
        "revision_manual": rules.manual_review(F.col("categoria_jerarquizada")),
        "marca": rules.classify_brand(F.col(code), F.col(name)),
        "unidad": rules.classify_unit(F.col(name)),
        "presentacion": rules.extract_presentation(F.col(name)),
    })


MASTER_COLUMNS = ["categoria_jerarquizada", "unidad", "marca"]


def master_values(classified: DataFrame, order: str) -> DataFrame:
    """Distinct categories, units and brands with ids in the order they were first seen.

    All three lists come from one scan. They are numbered as one ordered list without
    gathering it in a task; a list's ids are its numbers less those before it.
    """
    values = distinct_values(classified, MASTER_COLUMNS, order)
    numbered = number_rows(values, [F.col("columna"), F.col("primera_fila"), F.col("valor")], "_n")
    starts = numbered.groupBy("columna").agg(F.min("_n").alias("_start"))
    # One row per list, three in all.
    return numbered.join(F.broadcast(starts), "columna").select(
        "columna", "valor", "primera_fila", (F.col("_n") - F.col("_start") + 1).cast("int").alias("id"))


def master_table(values: DataFrame, column: str, id_name: str, name: str) -> DataFrame:
    return values.where(F.col("columna") == column).select(F.col("id").alias(id_name), F.col("valor").alias(name))


def stored_master_values(classified: DataFrame, order: str) -> DataFrame:
    """The master values, stored once as the dictionary that all later steps read."""
    return materialize(master_values(classified, order), "masters")


def build_masters(classified: DataFrame, order: str) -> dict[str, DataFrame]:
    values = stored_master_values(classified, order)
    return {
        "categoria_producto": master_table(values, "categoria_jerarquizada", "id_categoria", "nombre"),
        "unidad_medida": master_table(values, "unidad", "id_unidad", "codigo"),
        "marca_proveedor": master_table(values, "marca", "id_marca", "nombre_marca"),
    }


def with_master_ids(rows: DataFrame, values: DataFrame, targets: dict[str, str]) -> DataFrame:
    """``rows`` with the id that the dictionary (columna, valor, id) has for the value of each column in ``targets``; null if none.

    The combinations of values that occur are stacked, one row for each column, and meet the dictionary in one join; then
    the rows take the ids of their combination. Combinations are reduced inside each task first, so what travels is as
    small as the masters, and the dictionary is read once whatever the number of columns.
    """
    columns = list(targets)
    combined = rows.select(*columns).distinct().withColumn("_combination", F.struct(*columns))
    stacked = combined.select("_combination", F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in columns])))
    found = stacked.join(values.select("columna", "valor", "id"), ["columna", "valor"], "left")
    ids = found.groupBy("_combination").agg(*[F.max(F.when(F.col("columna") == c, F.col("id"))).alias(t) for c, t in targets.items()])
    side = ids.select(*[F.col("_combination")[c].alias(f"_{c}") for c in columns], *targets.values())
    same = F.lit(True)
    for c in columns:
        same = same & rows[c].eqNullSafe(side[f"_{c}"])
    return rows.join(side, same, "left").drop(*[f"_{c}" for c in columns])


MASTER_IDS = {"categoria_jerarquizada": "id_categoria", "marca": "id_marca", "unidad": "id_unidad"}


def build_product_master(classified: DataFrame, values: DataFrame, id_: str = "id_stg_inv",
                         code: str = "codigo_raw", name: str = "nombre_raw") -> DataFrame:
    """Product rows with the ids of category, brand and unit from the master values; a value that is none has a null id."""
    return with_master_ids(classified, values, MASTER_IDS).select(
        F.col(id_).alias("id_producto"), F.col(code).alias("codigo_producto"), F.col(name).alias("nombre"),
        "presentacion", *MASTER_IDS.values())


def category_dimension(categories: DataFrame) -> DataFrame:
    """Category master rows as dimension rows with recoded code, type and description."""
    recoded = rules.recode_category(F.col("nombre"))
    return categories.select(
        F.col("id_categoria").alias("sk_categoria"), recoded["codigo_categoria"].alias("nk_categoria"),
        F.col("nombre").alias("nombre_categoria"), recoded["tipo_producto"].alias("tipo_producto"),
        recoded["descripcion"].alias("descripcion"))


def brand_dimension(brands: DataFrame) -> DataFrame:
    """Brand master rows; the natural key is a copy of the name."""
    return brands.select(F.col("id_marca").alias("sk_marca"), "nombre_marca", F.col("nombre_marca").alias("nk_marca"))


def product_dimension(products: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    return products.select(
        F.col("id_producto").alias("sk_producto"), F.col("codigo_producto").alias("nk_codigo_producto"),
        F.col("nombre").alias("nombre_producto"), F.col("id_categoria").alias("sk_categoria"),
        F.col("id_marca").alias("sk_marca"), "presentacion", *[c.alias(n) for n, c in (extra or {}).items()])


def light_dimension(lights: DataFrame) -> DataFrame:
    return lights.select(F.col("id_semaforo").alias("id_tipo_semaforo"), F.col("color").alias("color_semaforo"),
                         F.col("rango").alias("rango_descripcion"))
