"""Constant reference tables. Each has a fixed, tiny number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions.dates import calendar_columns


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).upper()


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Constant rows as part of the plan: no job, no tasks, known size."""
    fields = [field.split() for field in schema.split(",")]
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    columns = ", ".join(f"CAST(c{i} AS {type_}) AS {name}" for i, (name, type_) in enumerate(fields))
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({names})")


def brand_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, V.BRAND_SEED, "nombre_marca string, pais_origen string, tipo_proveedor string").select(
        F.col("nombre_marca").alias("nk_marca"), "nombre_marca", "pais_origen", "tipo_proveedor",
        F.lit(False).alias("es_sin_definir"))


def category_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, V.CATEGORY_SEED, "nk_categoria string, nombre_categoria string, tipo_producto string")


def stock_states(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, V.STOCK_STATES,
        "sk_estado_stock int, nk_estado string, nombre_estado string, descripcion string, es_disponible boolean, "
        "requiere_accion boolean, color_semaforo string")


def discrepancy_types(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, V.DISCREPANCY_TYPES,
        "sk_tipo_disc int, nk_tipo_disc string, nombre_tipo string, descripcion string, impacto_financiero string, "
        "afecta_activos boolean, accion_recomendada string")


def lights(spark: SparkSession) -> DataFrame:
    return literal_table(spark, V.LIGHTS, "id_tipo_semaforo int, color_semaforo string, rango_descripcion string")


def load_processes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(p, "Nunca Ejecutado") for p in V.LOAD_PROCESSES],
                         "nombre_proceso string, estado_ultimo string")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1, numPartitions=1).select(F.explode(days).alias("fecha"))


def date_dimension(spark: SparkSession, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    columns = calendar_columns(F.col("fecha"))
    return calendar(spark, first, last).select(*[c.alias(n) for n, c in columns.items()])


def unknown_date(spark: SparkSession) -> DataFrame:
    """The row facts point to when a date is missing; its 0 parts are meant."""
    text = {"nombre_anio": "N/A", "nombre_trimestre": "N/A", "nombre_mes": "Desconocido", "anio_mes": "N/A",
            "nombre_semana": "N/A", "nombre_dia": "Desconocido", "nombre_feriado": None}
    row = {**{n: F.lit(0) for n in calendar_columns(F.current_date())},
           **{n: F.lit(v).cast("string") for n, v in text.items()},
           "sk_tiempo": F.lit(V.UNKNOWN_KEY), "fecha_completa": F.lit("1900-01-01").cast("date"),
           "es_fin_semana": F.lit(False), "es_feriado": F.lit(False)}
    return spark.range(1, numPartitions=1).select(*[c.alias(n) for n, c in row.items()])


def unknown_members(spark: SparkSession) -> dict[str, DataFrame]:
    """One "unknown" row per dimension."""
    key = V.UNKNOWN_KEY
    return {
        "dim_tiempo": unknown_date(spark),
        "dim_marca": literal_table(
            spark, [(key, V.UNKNOWN_BRAND, "Sin Marca Definida", "Desconocido", "Desconocido", True)],
            "sk_marca int, nk_marca string, nombre_marca string, pais_origen string, tipo_proveedor string, es_sin_definir boolean"),
        "dim_categoria": literal_table(
            spark, [(key, V.UNKNOWN_CATEGORY, V.UNDEFINED_CATEGORY, "Desconocido")],
            "sk_categoria int, nk_categoria string, nombre_categoria string, tipo_producto string"),
        "dim_producto": literal_table(
            spark, [(key, V.UNKNOWN_PRODUCT, "Producto Sin Definir", key, key, "1900-01-01", V.OPEN_END, True, True)],
            "sk_producto bigint, nk_codigo_producto string, nombre_producto string, sk_marca int, sk_categoria int, "
            "fecha_inicio_vigencia date, fecha_fin_vigencia date, es_registro_activo boolean, es_sin_definir boolean"),
    }
