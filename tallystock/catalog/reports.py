"""Business questions and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallystock.catalog.inputs import COUNT_KEY, LIGHT_DATE, Inputs, with_inputs
from tallystock.catalog.registry import pct, query
from tallystock.catalog.star_sql import BAND, DAY, ONE_COUNT, count_facts, fact, products, star_sql
from tallystock.plans import kpis
from tallystock.plans.movements import ageing_light, build_movements

_STAR = star_sql("inv_category", "inv_brand", "inv_dim_product")
# Numbers of one group of facts, from which the shares are made outside.
_COUNTED = """
count(*) AS n, count(*) FILTER (flag_discrepancia) AS n_diff, count(*) FILTER (flag_stock_cero) AS n_empty,
count(*) FILTER (flag_stock_cero AND cantidad_sistema > 0) AS n_unseen,
count(*) FILTER (NOT flag_discrepancia AND NOT flag_stock_cero) AS n_fine,
CAST(sum(cantidad_fisica) AS DOUBLE) AS f, CAST(sum(cantidad_sistema) AS DOUBLE) AS s, CAST(sum(diferencia_unids) AS DOUBLE) AS d,
CAST(coalesce(sum(diferencia_unids) FILTER (diferencia_unids > 0), 0) AS DOUBLE) AS more,
CAST(-coalesce(sum(diferencia_unids) FILTER (diferencia_unids < 0), 0) AS DOUBLE) AS fewer"""


def _ira(where: str = "true") -> str:
    return f"""
, g AS (SELECT sk_tiempo, sk_categoria, {_COUNTED} FROM fi WHERE {where} GROUP BY ALL)
SELECT sk_tiempo, {DAY} AS fecha_toma, sk_tiempo // 10000 AS anio, 'Diciembre' AS nombre_mes, nombre_categoria, tipo_producto,
       n AS total_skus, n - n_diff AS skus_exactos, n_diff AS skus_con_diferencia, {pct('n - n_diff', 'n')} AS ira_pct,
       CASE WHEN {pct('n - n_diff', 'n')} >= 95 THEN 'Cumple' ELSE 'Bajo Meta' END AS estado_meta,
       f AS total_unidades_fisicas, s AS total_unidades_sistema, d AS diferencia_neta
FROM g JOIN inv_category USING (sk_categoria)"""


_OUT = f"""n AS total_skus, n_empty AS skus_sin_stock, n - n_empty AS skus_con_stock, n_unseen AS agotados_no_reconocidos,
{pct('n_empty', 'n')} AS pct_quiebre"""
_RISK = f"""
risk AS (SELECT nk_codigo_producto, nombre_producto, b.nombre_marca, c.nombre_categoria,
       CAST(fecha_vencimiento AS VARCHAR) AS fecha_vencimiento, dias_para_vencer,
       {BAND} AS clasificacion_venc,
       CAST((dias_para_vencer * 20 + 30) // 60 AS DOUBLE) / 10 AS meses_restantes
FROM inv_dim_product p JOIN inv_brand b USING (sk_marca)
JOIN inv_category c ON c.sk_categoria = p.sk_categoria
WHERE es_registro_activo AND fecha_vencimiento IS NOT NULL AND dias_para_vencer BETWEEN 0 AND 365)"""


@query("kpi_ira", f"{_STAR} {_ira()}")
def _kpi_ira(t: Inputs) -> DataFrame:
    return kpis.kpi_ira(fact(t), t.dates(), t["inv_category"])


@query("kpi_stockout", f"""{_STAR}, g AS (SELECT sk_tiempo, sk_categoria, {_COUNTED} FROM fi GROUP BY ALL)
SELECT sk_tiempo, {DAY} AS fecha_toma, nombre_categoria, {_OUT} FROM g JOIN inv_category USING (sk_categoria)""")
def _kpi_stockout(t: Inputs) -> DataFrame:
    return kpis.kpi_stockout(fact(t), t.dates(), t["inv_category"])


@query("expiry_risk", f"{_STAR}, {_RISK} SELECT * FROM risk")
def _expiry_risk(t: Inputs) -> DataFrame:
    return kpis.expiry_risk(products(t), t["inv_brand"], t["inv_category"])


@query("pb01_ira_ranked", f"{_STAR} {_ira(ONE_COUNT)}")
def _ira_ranked(t: Inputs) -> DataFrame:
    return kpis.ira_ranked(fact(t, True), t.dates(), t["inv_category"], COUNT_KEY)


@query("pb02_discrepancies", f"""{_STAR}
SELECT p.nk_codigo_producto AS codigo, p.nombre_producto, c.nombre_categoria, b.nombre_marca,
       CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica, CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema,
       CAST(diferencia_unids AS DOUBLE) AS diferencia_unids,
       CASE WHEN diferencia_unids > 0 THEN 'Sobrante (Físico > Sistema)' ELSE 'Faltante (Sistema > Físico)' END
         AS tipo_diferencia,
       d.nombre_tipo AS causa, d.impacto_financiero, observacion_texto
FROM fi JOIN inv_dim_product p USING (sk_producto) JOIN inv_category c ON c.sk_categoria = fi.sk_categoria
JOIN inv_brand b ON b.sk_marca = fi.sk_marca JOIN causes d USING (nk_tipo_disc)
WHERE {ONE_COUNT} AND flag_discrepancia""")
def _discrepancies(t: Inputs) -> DataFrame:
    return kpis.discrepancies(*count_facts(t), products(t), t["inv_category"], t["inv_brand"],
                              t.causes(), COUNT_KEY)


@query("pb03_stockout_total", f"""{_STAR}, g AS (SELECT sk_categoria, {_COUNTED} FROM fi WHERE {ONE_COUNT} GROUP BY ALL),
every AS (SELECT {_COUNTED} FROM fi WHERE {ONE_COUNT}), one AS (SELECT {COUNT_KEY} AS sk_tiempo)
SELECT sk_tiempo, {DAY} AS fecha_toma, nombre_categoria, {_OUT} FROM one, g JOIN inv_category USING (sk_categoria)
UNION ALL SELECT sk_tiempo, {DAY}, 'TOTAL GLOBAL', {_OUT} FROM one, every""")
def _stockout_total(t: Inputs) -> DataFrame:
    return kpis.stockout_total(fact(t, True), t.dates(), t["inv_category"], COUNT_KEY)


@query("pb04_expiring_stock", f"""{_STAR}, {_RISK}
SELECT r.*, CAST(f.cantidad_fisica AS DOUBLE) AS stock_disponible
FROM risk r JOIN inv_dim_product p ON p.nombre_producto = r.nombre_producto AND p.es_registro_activo
JOIN fi f ON f.sk_producto = p.sk_producto WHERE {ONE_COUNT} AND f.cantidad_fisica > 0""")
def _expiring_stock(t: Inputs) -> DataFrame:
    return kpis.expiring_stock(fact(t, True), products(t), t["inv_brand"], t["inv_category"], COUNT_KEY)


@query("pb05_brand_share", f"""{_STAR}
SELECT b.nombre_marca, b.tipo_proveedor, count(DISTINCT sk_producto) AS num_skus,
       CAST(sum(cantidad_fisica) AS DOUBLE) AS total_stock_fisico,
       CAST(sum(cantidad_sistema) AS DOUBLE) AS total_stock_sistema,
       {pct('sum(cantidad_fisica) * 100', 'sum(sum(cantidad_fisica)) OVER () * 100')} AS pct_del_total,
       CAST(sum(CASE WHEN flag_discrepancia THEN 1 ELSE 0 END) AS BIGINT) AS skus_con_discrepancia
FROM fi JOIN inv_brand b USING (sk_marca) WHERE {ONE_COUNT} GROUP BY b.nombre_marca, b.tipo_proveedor""")
def _brand_share(t: Inputs) -> DataFrame:
    return kpis.brand_share(fact(t, True), t["inv_brand"], COUNT_KEY)


@query("pb06_pending_running", f"""{_STAR}
SELECT p.nk_codigo_producto, p.nombre_producto, c.nombre_categoria,
       CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica, CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema,
       CAST(abs(diferencia_unids) AS DOUBLE) AS unidades_pendientes, observacion_texto,
       CAST(sum(abs(diferencia_unids)) OVER (ORDER BY abs(diferencia_unids) DESC, sk_producto
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS acumulado_pendiente
FROM fi JOIN inv_dim_product p USING (sk_producto) JOIN inv_category c ON c.sk_categoria = fi.sk_categoria
WHERE {ONE_COUNT} AND nk_tipo_disc = 'PR'""")
def _pending_running(t: Inputs) -> DataFrame:
    return kpis.pending_running(*count_facts(t), products(t), t["inv_category"], t.causes(),
                                COUNT_KEY)


@query("dashboard", f"""{_STAR}, every AS (SELECT {_COUNTED} FROM fi WHERE {ONE_COUNT}), one AS (SELECT {COUNT_KEY} AS sk_tiempo)
SELECT {DAY} AS fecha_toma, n AS total_skus, n_fine AS skus_ok, n_diff AS skus_con_discrepancia, n_empty AS skus_sin_stock,
       {pct('n - n_diff', 'n')} AS ira_global_pct, {pct('n_empty', 'n')} AS pct_quiebre_stock, f AS total_unidades_fisicas,
       s AS total_unidades_sistema, d AS diferencia_neta_total, more AS total_sobrante_uds, fewer AS total_faltante_uds
FROM every, one""")
def _dashboard(t: Inputs) -> DataFrame:
    return kpis.dashboard(fact(t, True), t.dates(), COUNT_KEY)


# Movements and ageing light, shared with the warehouse queries.
MOVEMENT_INPUTS = with_inputs("inv_product", "inv_inflow", "inv_inflow_header", "inv_outflow")
MOVEMENTS = """moves AS (
SELECT id_producto, 1 AS id_tipo_mov, CAST(try_strptime(h.fecha, '%d/%m/%Y') AS DATE) AS fecha_movimiento, cantidad
FROM inv_inflow i JOIN inv_product p ON p.codigo_producto = i.codigo
LEFT JOIN inv_inflow_header h ON h.codigo = i.id_entrada
UNION ALL
SELECT id_producto, CASE WHEN cantidad > 0 THEN 1 ELSE 2 END, CAST(try_strptime(o.fecha, '%d/%m/%Y') AS DATE), cantidad
FROM inv_outflow o JOIN inv_product p ON p.codigo_producto = o.serie)"""
LIGHT = f"""light AS (
SELECT p.id_producto, p.codigo_producto, last AS ultima_modificacion,
       CAST(DATE '{LIGHT_DATE}' - last AS INT) AS dias_inventariado,
       CASE WHEN last IS NULL THEN 'Revisión' WHEN DATE '{LIGHT_DATE}' - last <= 90 THEN 'Verde'
            WHEN DATE '{LIGHT_DATE}' - last <= 365 THEN 'Amarillo' ELSE 'Rojo' END AS color_semaforo,
       CASE WHEN last IS NULL THEN 4 WHEN DATE '{LIGHT_DATE}' - last <= 90 THEN 1
            WHEN DATE '{LIGHT_DATE}' - last <= 365 THEN 2 ELSE 3 END AS id_semaforo
FROM inv_product p LEFT JOIN (
  SELECT id_producto, max(fecha_movimiento) AS last FROM moves
  WHERE id_tipo_mov = 1 AND (cantidad IS NULL OR cantidad NOT IN (1, 2, 2.5, 3, 4, 5)) GROUP BY id_producto) m
USING (id_producto))"""


def movements(t: Inputs) -> DataFrame:
    return build_movements(t["inv_inflow"], t["inv_inflow_header"], t["inv_outflow"], t["inv_product"])


def light(t: Inputs, ids: DataFrame | None = None) -> DataFrame:
    control = t["inv_product"].select("id_producto", "codigo_producto")
    return ageing_light(control, movements(t), LIGHT_DATE, ids)


@query("critical_share", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}, {LIGHT}
SELECT id_semaforo, color_semaforo, count(*) AS productos,
       {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct
FROM light GROUP BY id_semaforo, color_semaforo""")
def _critical_share(t: Inputs) -> DataFrame:
    return kpis.critical_share(light(t))
