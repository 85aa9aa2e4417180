"""Aggregates, ordered operators, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import AS_OF, Inputs, with_inputs
from tallystock.catalog.registry import pct, query
from tallystock.catalog.reports import MOVEMENT_INPUTS, MOVEMENTS, movements
from tallystock.catalog.rules_sql import CLASSIFIED
from tallystock.catalog.star_sql import discrepancy, fact, star_sql
from tallystock.functions.measures import count_if, ratio_pct, shortage, surplus
from tallystock.operators.aggregates import dedupe_by_key, detail_plus_total, version_stats
from tallystock.operators.lookups import join_dimensions
from tallystock.operators.ordering import any_row, sort_rows
from tallystock.operators.windows import latest_per_key, number_rows, running_total, share_of_total
from tallystock.plans.history import first_versions, scd2_merge
from tallystock.plans.masters import classify_products
from tallystock.sources.seeds import stock_states

_STAR = star_sql("inv_category", "inv_brand")
_D = "diferencia_unids"


def _sum(expr: str, name: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE) AS {name}"


@query("count_if", f"""{_STAR}
SELECT sk_tiempo, CAST(sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END) AS BIGINT) AS con_diferencia,
       CAST(sum(CASE WHEN flag_stock_cero AND cantidad_sistema > 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_reconocidos
FROM fi GROUP BY sk_tiempo""")
def _count_if(t: Inputs) -> DataFrame:
    return fact(t).groupBy("sk_tiempo").agg(
        count_if(F.col("flag_discrepancia")).alias("con_diferencia"),
        count_if(F.col("flag_stock_cero") & (F.col("cantidad_sistema") > 0)).alias("no_reconocidos"))


@query("ratio_pct", f"""{_STAR}
SELECT sk_marca, {pct('sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END)', 'count(*)')} AS pct_diferencia,
       {pct('sum(cantidad_fisica) * 100', 'sum(cantidad_sistema) * 100')} AS pct_cobertura FROM fi GROUP BY sk_marca""")
def _ratio(t: Inputs) -> DataFrame:
    sums = fact(t).groupBy("sk_marca").agg(
        count_if(F.col("flag_discrepancia")).alias("d"), F.count("*").alias("n"),
        F.sum("cantidad_fisica").alias("f"), F.sum("cantidad_sistema").alias("s"))
    return sums.select("sk_marca", ratio_pct(F.col("d"), F.col("n")).alias("pct_diferencia"),
                       ratio_pct(F.col("f"), F.col("s")).alias("pct_cobertura"))


@query("sum_measures", f"""{_STAR}
SELECT sk_tiempo, {_sum('cantidad_fisica', 'fisica')}, {_sum('cantidad_sistema', 'sistema')}, {_sum(_D, 'diferencia')}
FROM fi GROUP BY sk_tiempo""")
def _sums(t: Inputs) -> DataFrame:
    return fact(t).groupBy("sk_tiempo").agg(
        F.sum("cantidad_fisica").alias("fisica"), F.sum("cantidad_sistema").alias("sistema"), F.sum(_D).alias("diferencia"))


@query("count_distinct", f"{_STAR} SELECT sk_marca, count(DISTINCT sk_producto) AS num_skus FROM fi GROUP BY sk_marca")
def _distinct(t: Inputs) -> DataFrame:
    return fact(t).groupBy("sk_marca").agg(F.countDistinct("sk_producto").alias("num_skus"))


@query("group_by_many", f"""{_STAR}
SELECT sk_tiempo, nombre_categoria, nombre_marca, nk_estado, flag_discrepancia, flag_stock_cero, count(*) AS filas,
       {_sum('cantidad_fisica', 'fisica')} FROM fi GROUP BY ALL""")
def _group(t: Inputs) -> DataFrame:
    keys = ["sk_tiempo", "sk_categoria", "sk_marca", "sk_estado_stock", "flag_discrepancia", "flag_stock_cero"]
    sums = fact(t).groupBy(*keys).agg(F.count("*").alias("filas"), F.sum("cantidad_fisica").alias("fisica"))
    named = join_dimensions(
        sums, (t["inv_category"].select("sk_categoria", "nombre_categoria"), "sk_categoria"),
        (t["inv_brand"].select("sk_marca", "nombre_marca"), "sk_marca"),
        (stock_states(t.spark).select("sk_estado_stock", "nk_estado"), "sk_estado_stock"))
    return named.drop("sk_categoria", "sk_marca", "sk_estado_stock")


@query("global_agg", f"""{_STAR}
SELECT count(*) AS filas, count(DISTINCT sk_tiempo) AS tomas, {_sum('cantidad_fisica', 'fisica')},
       CAST(max({_D}) AS DOUBLE) AS mayor, CAST(min({_D}) AS DOUBLE) AS menor FROM fi""")
def _global(t: Inputs) -> DataFrame:
    return fact(t).agg(
        F.count("*").alias("filas"), F.countDistinct("sk_tiempo").alias("tomas"), F.sum("cantidad_fisica").alias("fisica"),
        F.max(_D).alias("mayor"), F.min(_D).alias("menor"))


@query("detail_plus_total", f"""{_STAR}
SELECT sk_tiempo, nombre_categoria, count(*) AS filas, CAST(sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END) AS BIGINT) AS con_diferencia,
       {pct('sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END)', 'count(*)')} AS pct FROM fi GROUP BY sk_tiempo, nombre_categoria
UNION ALL SELECT sk_tiempo, 'TOTAL GLOBAL', count(*), CAST(sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END) AS BIGINT),
       {pct('sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END)', 'count(*)')} FROM fi GROUP BY sk_tiempo""")
def _detail(t: Inputs) -> DataFrame:
    counts = fact(t).groupBy("sk_tiempo", "sk_categoria").agg(
        F.count("*").alias("filas"), count_if(F.col("flag_discrepancia")).alias("con_diferencia"))
    detail = join_dimensions(counts, (t["inv_category"].select("sk_categoria", "nombre_categoria"), "sk_categoria"))
    return detail_plus_total(
        detail.drop("sk_categoria"), counts, "nombre_categoria", "TOTAL GLOBAL", {"sk_tiempo": None}, ["filas", "con_diferencia"],
        {"pct": ratio_pct(F.col("con_diferencia"), F.col("filas"))})


@query("signed_split", f"""{_STAR}
SELECT sk_tiempo, {_sum(f'CASE WHEN {_D} > 0 THEN {_D} ELSE 0 END', 'sobrante')},
       CAST(abs(sum(CASE WHEN {_D} < 0 THEN {_D} ELSE 0 END)) AS DOUBLE) AS faltante FROM fi GROUP BY sk_tiempo""")
def _signed(t: Inputs) -> DataFrame:
    return fact(t).groupBy("sk_tiempo").agg(surplus(F.col(_D)).alias("sobrante"), shortage(F.col(_D)).alias("faltante"))


# Each presentation and its first product by code; repeats of a product, and products without a presentation, included.
@query("dedupe_by_key", f"""{with_inputs('inv_product')}, {CLASSIFIED}, twice AS (
  SELECT id_producto, codigo_producto, nombre, presentacion, marca FROM classified UNION ALL
  SELECT id_producto, codigo_producto, nombre, presentacion, marca FROM classified WHERE id_producto % 3 = 0)
SELECT id_producto, codigo_producto, nombre, presentacion, marca FROM (
  SELECT *, row_number() OVER (PARTITION BY presentacion ORDER BY codigo_producto, id_producto) AS r FROM twice) x WHERE r = 1""")
def _dedupe(t: Inputs) -> DataFrame:
    found = classify_products(t["inv_product"].drop("marca"), "codigo_producto", "nombre").select(
        "id_producto", "codigo_producto", "nombre", "presentacion", "marca")
    twice = found.unionAll(found.where("id_producto % 3 = 0"))
    return dedupe_by_key(twice, "presentacion", [F.col("codigo_producto"), F.col("id_producto")])


@query("version_stats", f"""{with_inputs('inv_product_v1', 'inv_product_v2')}, changed AS (
SELECT count(*) AS n FROM inv_product_v1 a JOIN inv_product_v2 b USING (id)
WHERE a.nombre <> b.nombre OR a.fecha_vencimiento IS DISTINCT FROM b.fecha_vencimiento),
fresh AS (SELECT count(*) AS n FROM inv_product_v2 WHERE id NOT IN (SELECT id FROM inv_product_v1))
SELECT 'DIM_PRODUCTO' AS nombre_dimension, (SELECT count(*) FROM inv_product_v1) + c.n + f.n AS total_registros,
       (SELECT count(*) FROM inv_product_v1) + f.n AS registros_activos, c.n AS registros_hist FROM changed c, fresh f""")
def _versions(t: Inputs) -> DataFrame:
    merged = scd2_merge(first_versions(t["inv_product_v1"], "2001-01-01"), t["inv_product_v2"], AS_OF)
    return version_stats(merged, "DIM_PRODUCTO")


@query("delta_by_category", f"{_STAR} SELECT nombre_categoria, {_sum(_D, 'delta')} FROM fi GROUP BY nombre_categoria")
def _delta(t: Inputs) -> DataFrame:
    per_key = fact(t).groupBy("sk_categoria").agg(F.sum(_D).alias("delta"))
    return join_dimensions(per_key, (t["inv_category"].select("sk_categoria", "nombre_categoria"), "sk_categoria")).drop(
        "sk_categoria")


@query("share_of_total", f"""{_STAR}
SELECT sk_tiempo, sk_marca, {_sum('cantidad_fisica', 'fisica')},
       {pct('sum(cantidad_fisica) * 100', 'sum(sum(cantidad_fisica)) OVER () * 100')} AS pct_del_total
FROM fi GROUP BY sk_tiempo, sk_marca""")
def _share(t: Inputs) -> DataFrame:
    groups = fact(t).groupBy("sk_tiempo", "sk_marca").agg(F.sum("cantidad_fisica").alias("fisica"))
    return share_of_total(groups, "fisica", "pct_del_total")


@query("running_total", f"""{_STAR}
SELECT sk_tiempo, sk_producto, CAST(abs({_D}) AS DOUBLE) AS unidades,
       CAST(sum(abs({_D})) OVER (ORDER BY abs({_D}) DESC, sk_tiempo, sk_producto
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS acumulado
FROM fi WHERE flag_discrepancia""")
def _running(t: Inputs) -> DataFrame:
    units = discrepancy(t).select("sk_tiempo", "sk_producto", F.col("unidades_diferencia").alias("unidades"))
    order = [F.col("unidades").desc(), F.col("sk_tiempo"), F.col("sk_producto")]
    return running_total(units, F.col("unidades"), order, "acumulado")


@query("enumerate_rows", """
SELECT p_name, p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS "RowNo" FROM part""")
def _enumerate(t: Inputs) -> DataFrame:
    return number_rows(t.table("part").select("p_name", "p_partkey"), [F.col("p_name"), F.col("p_partkey")])


@query("latest_per_key", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT id_producto, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento, CAST(cantidad AS DOUBLE) AS cantidad FROM (
  SELECT *, row_number() OVER (PARTITION BY id_producto ORDER BY fecha_movimiento DESC NULLS LAST, cantidad DESC) AS r
  FROM moves WHERE id_tipo_mov = 1) x WHERE r = 1""")
def _latest(t: Inputs) -> DataFrame:
    rows = movements(t).where("id_tipo_mov = 1")
    return latest_per_key(rows, "id_producto", "fecha_movimiento", [F.col("cantidad").desc()]).select(
        "id_producto", "fecha_movimiento", "cantidad")


@query("sort_multi", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT id_producto, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento, CAST(cantidad AS DOUBLE) AS cantidad FROM moves""")
def _sort(t: Inputs) -> DataFrame:
    rows = movements(t).select("id_producto", "fecha_movimiento", "cantidad")
    return sort_rows(rows, F.col("id_producto").asc(), F.col("fecha_movimiento").desc(), copies=True)


@query("order_result", f"""{_STAR} SELECT sk_tiempo, sk_producto, CAST({_D} AS DOUBLE) AS diferencia FROM fi WHERE flag_discrepancia""")
def _order(t: Inputs) -> DataFrame:
    rows = fact(t).where("flag_discrepancia").select("sk_tiempo", "sk_producto", F.col(_D).alias("diferencia"))
    return sort_rows(rows, F.abs("diferencia").desc())


@query("limit_one", f"""{with_inputs('inv_file')}
SELECT EXISTS (SELECT 1 FROM inv_file WHERE hash_md5 IN (SELECT hash_md5 FROM inv_file WHERE id_archivo_log % 10 = 0)
               AND id_archivo_log % 10 <> 0) AS hay_duplicado""")
def _limit(t: Inputs) -> DataFrame:
    every = t["inv_file"]
    old = F.col("id_archivo_log") % 10 == 0
    logged = every.where(old).select("hash_md5").distinct()
    return any_row(every.where(~old).join(logged, "hash_md5", "left_semi"), "hay_duplicado")
