"""Business questions on the star schema.

Reports first add up the fact by its keys (partial sums leave each task), and join the
dimensions to that small result. The last grouping is by the attributes asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.functions.dates import days_to_months
from tallystock.functions.measures import count_if, goal_mark, ratio_pct, shortage, surplus
from tallystock.operators.aggregates import detail_plus_total
from tallystock.operators.filters import active_between, positive_stock_filter, snapshot_filter
from tallystock.operators.lookups import join_dimensions, join_keys
from tallystock.operators.ordering import sort_rows
from tallystock.operators.windows import running_total, share_of_total


def _different() -> Column:
    return F.col("flag_discrepancia")


def _empty() -> Column:
    return F.col("flag_stock_cero")


def _count(fact: DataFrame, sk_tiempo: int | None) -> DataFrame:
    return fact if sk_tiempo is None else snapshot_filter(fact, sk_tiempo)


def kpi_ira(fact: DataFrame, dates: DataFrame, categories: DataFrame, sk_tiempo: int | None = None) -> DataFrame:
    """Record accuracy per count and category, with goal mark and unit totals."""
    by_key = _count(fact, sk_tiempo).groupBy("sk_tiempo", "sk_categoria").agg(
        F.count("*").alias("n"), count_if(~_different()).alias("exact"), count_if(_different()).alias("diff"),
        F.sum("cantidad_fisica").alias("f"), F.sum("cantidad_sistema").alias("s"), F.sum("diferencia_unids").alias("d"))
    joined = join_dimensions(
        by_key,
        (dates.select("sk_tiempo", F.col("fecha_completa").alias("fecha_toma"), "anio", "nombre_mes"), "sk_tiempo"),
        (categories.select("sk_categoria", "nombre_categoria", "tipo_producto"), "sk_categoria"))
    pct = ratio_pct(F.col("skus_exactos"), F.col("total_skus"))
    return joined.groupBy("sk_tiempo", "fecha_toma", "anio", "nombre_mes", "nombre_categoria", "tipo_producto").agg(
        F.sum("n").alias("total_skus"), F.sum("exact").alias("skus_exactos"),
        F.sum("diff").alias("skus_con_diferencia"), F.sum("f").alias("total_unidades_fisicas"),
        F.sum("s").alias("total_unidades_sistema"), F.sum("d").alias("diferencia_neta"),
    ).withColumn("ira_pct", pct).withColumn("estado_meta", goal_mark(F.col("ira_pct")))


def kpi_stockout(fact: DataFrame, dates: DataFrame, categories: DataFrame, sk_tiempo: int | None = None) -> DataFrame:
    """Stock-out share per count and category, and stock the system still believes in."""
    counts = _stockout_named(_stockout_by_key(fact, sk_tiempo), dates, categories)
    return counts.withColumn("pct_quiebre", ratio_pct(F.col("skus_sin_stock"), F.col("total_skus")))


STOCKOUT_SUMS = ["total_skus", "skus_sin_stock", "skus_con_stock", "agotados_no_reconocidos"]


def _stockout_by_key(fact: DataFrame, sk_tiempo: int | None) -> DataFrame:
    return _count(fact, sk_tiempo).groupBy("sk_tiempo", "sk_categoria").agg(
        F.count("*").alias("total_skus"), count_if(_empty()).alias("skus_sin_stock"),
        count_if(~_empty()).alias("skus_con_stock"),
        count_if(_empty() & (F.col("cantidad_sistema") > 0)).alias("agotados_no_reconocidos"))


def _stockout_named(by_key: DataFrame, dates: DataFrame, categories: DataFrame) -> DataFrame:
    joined = join_dimensions(
        by_key, (dates.select("sk_tiempo", F.col("fecha_completa").alias("fecha_toma")), "sk_tiempo"),
        (categories.select("sk_categoria", "nombre_categoria"), "sk_categoria"))
    return joined.groupBy("sk_tiempo", "fecha_toma", "nombre_categoria").agg(
        *[F.sum(c).alias(c) for c in STOCKOUT_SUMS])


def expiry_risk(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Active products that expire within a year, with the months left."""
    risk = join_dimensions(
        active_between(products), (brands.select("sk_marca", "nombre_marca"), "sk_marca"),
        (categories.select("sk_categoria", "nombre_categoria"), "sk_categoria"),
    ).select("nk_codigo_producto", "nombre_producto", "nombre_marca", "nombre_categoria", "fecha_vencimiento",
             "dias_para_vencer", "clasificacion_venc",
             days_to_months(F.col("dias_para_vencer")).alias("meses_restantes"))
    return risk


def ira_ranked(fact: DataFrame, dates: DataFrame, categories: DataFrame, sk_tiempo: int) -> DataFrame:
    """Accuracy of one count, worst category first."""
    return sort_rows(kpi_ira(fact, dates, categories, sk_tiempo), F.col("ira_pct"))


def direction(difference: Column) -> Column:
    return F.when(difference > 0, "Sobrante (Físico > Sistema)").otherwise("Faltante (Sistema > Físico)")


def discrepancies(fact: DataFrame, discrepancy: DataFrame, products: DataFrame, categories: DataFrame,
                  brands: DataFrame, causes: DataFrame, sk_tiempo: int) -> DataFrame:
    """Products of one count that differ, with cause and direction, largest first."""
    both = _fact_pair(fact, discrepancy, sk_tiempo)
    joined = join_dimensions(
        both, (products.select("sk_producto", "nk_codigo_producto", "nombre_producto"), "sk_producto"),
        (categories.select("sk_categoria", "nombre_categoria"), "sk_categoria"),
        (brands.select("sk_marca", "nombre_marca"), "sk_marca"))
    named = joined.join(causes.select("sk_tipo_disc", "nombre_tipo", "impacto_financiero"), "sk_tipo_disc")
    listed = named.select(
        F.col("nk_codigo_producto").alias("codigo"), "nombre_producto", "nombre_categoria", "nombre_marca",
        "cantidad_fisica", "cantidad_sistema", "diferencia_unids",
        direction(F.col("diferencia_unids")).alias("tipo_diferencia"), F.col("nombre_tipo").alias("causa"),
        "impacto_financiero", "observacion_texto")
    return sort_rows(listed, F.abs("diferencia_unids").desc())


def _fact_pair(fact: DataFrame, discrepancy: DataFrame, sk_tiempo: int) -> DataFrame:
    """Inventory and discrepancy rows of one count; shared columns come from the inventory side."""
    return join_keys(
        snapshot_filter(fact, sk_tiempo),
        snapshot_filter(discrepancy, sk_tiempo).select("sk_tiempo", "sk_producto", "sk_tipo_disc", "observacion_texto"),
        ["sk_tiempo", "sk_producto"])


def stockout_total(fact: DataFrame, dates: DataFrame, categories: DataFrame, sk_tiempo: int) -> DataFrame:
    """Stock-out of one count per category plus a global row.

    The global row counts the fact itself, whatever the dimensions hold, and is there for a
    count without rows too; Spark runs the grouped fact once for both parts.
    """
    pct = ratio_pct(F.col("skus_sin_stock"), F.col("total_skus"))
    by_key = _stockout_by_key(fact, sk_tiempo)
    day = dates.where(F.col("sk_tiempo") == sk_tiempo).select("fecha_completa").scalar()
    keys = {"sk_tiempo": F.lit(sk_tiempo), "fecha_toma": day}
    return detail_plus_total(
        _stockout_named(by_key, dates, categories), by_key, "nombre_categoria", "TOTAL GLOBAL", keys, STOCKOUT_SUMS,
        {"pct_quiebre": pct})


def expiring_stock(fact: DataFrame, products: DataFrame, brands: DataFrame, categories: DataFrame,
                   sk_tiempo: int, on: str = "nombre_producto") -> DataFrame:
    """Products at expiry risk with the stock of one count.

    The report joins back on the product name, as asked; a name shared by several active
    products gives a row for each. ``on="nk_codigo_producto"`` joins on the key instead.
    Stock is reduced to the active products that hold any before the join.
    """
    risk = expiry_risk(products, brands, categories)
    stock = positive_stock_filter(snapshot_filter(fact, sk_tiempo)).select(
        "sk_producto", F.col("cantidad_fisica").alias("stock_disponible"))
    held = products.where("es_registro_activo").select("sk_producto", F.col(on).alias("_on")).join(stock, "sk_producto")
    return sort_rows(risk.join(held, F.col(on) == F.col("_on")).drop("_on", "sk_producto"), F.col("dias_para_vencer"))


def brand_share(fact: DataFrame, brands: DataFrame, sk_tiempo: int) -> DataFrame:
    """Stock per brand and its share of all stock in one count, largest first."""
    by_key = snapshot_filter(fact, sk_tiempo).groupBy("sk_marca").agg(
        F.countDistinct("sk_producto").alias("n"), F.sum("cantidad_fisica").alias("f"),
        F.sum("cantidad_sistema").alias("s"), count_if(_different()).alias("d"))
    # A product has one row per count and one brand, so its distinct counts add up over brand keys.
    groups = join_dimensions(by_key, (brands.select("sk_marca", "nombre_marca", "tipo_proveedor"), "sk_marca")).groupBy(
        "nombre_marca", "tipo_proveedor").agg(
        F.sum("n").alias("num_skus"), F.sum("f").alias("total_stock_fisico"),
        F.sum("s").alias("total_stock_sistema"), F.sum("d").alias("skus_con_discrepancia"))
    return sort_rows(share_of_total(groups, "total_stock_fisico", "pct_del_total"), F.desc("total_stock_fisico"))


def pending_running(fact: DataFrame, discrepancy: DataFrame, products: DataFrame, categories: DataFrame,
                    causes: DataFrame, sk_tiempo: int) -> DataFrame:
    """Units still to be deducted, largest first, with a running total (ties in product order)."""
    code = causes.where(F.col("nk_tipo_disc") == "PR").select("sk_tipo_disc")
    pending = _fact_pair(fact, discrepancy.join(code, "sk_tipo_disc", "left_semi"), sk_tiempo)
    joined = join_dimensions(
        pending, (products.select("sk_producto", "nk_codigo_producto", "nombre_producto"), "sk_producto"),
        (categories.select("sk_categoria", "nombre_categoria"), "sk_categoria"))
    units = joined.select(
        "sk_producto", "nk_codigo_producto", "nombre_producto", "nombre_categoria", "cantidad_fisica",
        "cantidad_sistema", F.abs("diferencia_unids").alias("unidades_pendientes"), "observacion_texto")
    order = [F.col("unidades_pendientes").desc(), F.col("sk_producto")]
    return running_total(units, F.col("unidades_pendientes"), order, "acumulado_pendiente").drop("sk_producto")


def dashboard(fact: DataFrame, dates: DataFrame, sk_tiempo: int) -> DataFrame:
    """Twelve figures of one count in one row, from one pass over the fact."""
    d = F.col("diferencia_unids")
    day = dates.where(F.col("sk_tiempo") == sk_tiempo).select("fecha_completa").scalar()
    sums = snapshot_filter(fact, sk_tiempo).agg(
        F.count("*").alias("total_skus"), count_if(~_different()).alias("_exact"),
        count_if(_different()).alias("skus_con_discrepancia"), count_if(_empty()).alias("skus_sin_stock"),
        count_if(~_different() & ~_empty()).alias("skus_ok"), F.sum("cantidad_fisica").alias("total_unidades_fisicas"),
        F.sum("cantidad_sistema").alias("total_unidades_sistema"), F.sum(d).alias("diferencia_neta_total"),
        surplus(d).alias("total_sobrante_uds"), shortage(d).alias("total_faltante_uds"))
    return sums.select(
        day.alias("fecha_toma"), ratio_pct(F.col("_exact"), F.col("total_skus")).alias("ira_global_pct"),
        ratio_pct(F.col("skus_sin_stock"), F.col("total_skus")).alias("pct_quiebre_stock"),
        *[c for c in sums.columns if c != "_exact"])


def critical_share(light: DataFrame) -> DataFrame:
    """Products by ageing light and the share of each."""
    counts = light.groupBy("id_semaforo", "color_semaforo").agg(F.count("*").alias("productos"))
    return share_of_total(counts, "productos", "pct")
