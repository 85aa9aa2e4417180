"""Facts and derived attributes of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.sources.seeds import discrepancy_types, stock_states

# Ours: the bands are named by the data model, their limits in days are not.
EXPIRY_BANDS = [("Critico", 90), ("Alerta", 180), ("Vigilancia", 365)]


def generated_measures(physical: Column, system: Column) -> dict[str, Column]:
    return {
        "diferencia_unids": (physical - system).cast("decimal(12,2)"),
        "flag_discrepancia": physical != system,
        "flag_stock_cero": physical == 0,
    }


def expiry_band(days: Column, bands: list[tuple[str, int]] | None = None) -> Column:
    chain = F.when(days.isNull(), "Sin Vencimiento").when(days < 0, "Vencido")
    for name, limit in bands or EXPIRY_BANDS:
        chain = chain.when(days <= limit, name)
    return chain.otherwise("Normal")


def stock_status(f: Column, s: Column) -> Column:
    return (
        F.when((f > 0) & (f == s), "DISP_OK")
        .when((f > 0) & (f < s), "DISP_FALT")
        .when((f > 0) & (f > s), "DISP_SOBRANTE")
        .when((f == 0) & (s == 0), "SIN_STOCK")
        .when((f == 0) & (s > 0), "AGOTADO_DESAC")
        .otherwise("PEND_REVISION")
    )


def discrepancy_cause(difference: Column, note: Column) -> Column:
    """Cause of a difference from the free text next to it (text rules are ours)."""
    text = F.upper(F.coalesce(note, F.lit("")))
    noted = F.trim(text) != ""
    return (
        F.when(difference == 0, "ND")
        .when(text.contains("REBAJAR"), "PR")
        .when(text.contains("ENTREGA"), "EP")
        .when(text.contains("FALTANTE") & (difference < 0), "FF")
        .when(text.contains("SOBRANTE") & (difference > 0), "SNR")
        .when(noted, F.when(difference > 0, "SCN").otherwise("FCN"))
        .otherwise(F.when(difference > 0, "SSJ").otherwise("FSJ"))
    )


def build_fact_inventory(counts: DataFrame, load_id: int = 0) -> DataFrame:
    """One row per product and count, with keys, measures, stock state and ageing light.

    A missing key points to the unknown member. The stock-state key comes from a table of
    six rows, the only side that is broadcast.
    """
    f, s = F.col("cantidad_fisica"), F.col("cantidad_sistema")
    states = stock_states(counts.sparkSession).select("sk_estado_stock", F.col("nk_estado").alias("_estado"))
    for column, type_ in [("sk_tipo_semaforo", "int"), ("dias_inventariados", "int")]:
        if column not in counts.columns:
            counts = counts.withColumn(column, F.lit(None).cast(type_))
    keyed = counts.withColumns({
        **{k: F.coalesce(F.col(k), F.lit(V.UNKNOWN_KEY)) for k in ["sk_tiempo", "sk_producto", "sk_categoria", "sk_marca"]},
        **generated_measures(f, s),
        "_estado": stock_status(f, s),
    })
    return keyed.join(F.broadcast(states), "_estado").select(
        "sk_tiempo", "sk_producto", "sk_categoria", "sk_marca", "sk_estado_stock", "sk_tipo_semaforo",
        "dias_inventariados", "cantidad_fisica", "cantidad_sistema", "diferencia_unids", "flag_discrepancia",
        "flag_stock_cero", F.lit(load_id).alias("id_carga_origen"))


def known_keys(counts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """``counts`` whose keys that a dimension does not hold, or that are missing, point to its unknown member.

    A fact loaded like this loses no row in a report, whatever dimensions the report joins.
    """
    for key, dimension in dimensions.items():
        held = dimension.select(F.col(key).alias("_held")).distinct()
        found = counts.join(held, F.col(key) == F.col("_held"), "left")
        counts = found.withColumn(key, F.coalesce("_held", F.lit(V.UNKNOWN_KEY)).cast(counts.schema[key].dataType)).drop("_held")
    return counts


def build_fact_discrepancy(counts: DataFrame, load_id: int = 0) -> DataFrame:
    """Rows with a difference: absolute units, sign, both quantities, note and cause.

    A missing key points to the unknown member, as in the inventory fact.
    """
    counts = counts.withColumns({
        k: F.coalesce(F.col(k), F.lit(V.UNKNOWN_KEY)) for k in ["sk_tiempo", "sk_producto", "sk_categoria", "sk_marca"]})
    difference = F.col("cantidad_fisica") - F.col("cantidad_sistema")
    causes = discrepancy_types(counts.sparkSession).select("sk_tipo_disc", F.col("nk_tipo_disc").alias("_causa"))
    different = counts.where(difference != 0).withColumns({
        "unidades_diferencia": F.abs(difference).cast("decimal(12,2)"),
        "signo_diferencia": F.when(difference > 0, "+").otherwise("-"),
        "_causa": discrepancy_cause(difference, F.col("observacion_texto")),
    })
    return different.join(F.broadcast(causes), "_causa").select(
        "sk_tiempo", "sk_producto", "sk_categoria", "sk_marca", "sk_tipo_disc", "unidades_diferencia",
        "signo_diferencia", "cantidad_fisica", "cantidad_sistema", "observacion_texto",
        F.lit(load_id).alias("id_carga_origen"))
