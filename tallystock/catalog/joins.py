"""Lookups, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import Inputs, with_inputs
from tallystock.catalog.quality_sql import CATALOGUE, KARDEX, LOADS, LOTS, MAIN, SHEET_INPUTS, loads
from tallystock.catalog.registry import pct, query
from tallystock.catalog.reports import MOVEMENT_INPUTS, MOVEMENTS
from tallystock.catalog.star_sql import DAY, ONE_COUNT, fact, products, star_sql, stored_facts
from tallystock.functions.measures import ratio_pct
from tallystock.operators import lookups as J
from tallystock.plans.movements import append_two_flows, dated_headers, header_detail_join, inflows, movement_rows, outflows
from tallystock.sources.seeds import calendar, unknown_members
from tallystock.sources.tables import anti_join_new_keys

_STAR = star_sql("inv_category", "inv_brand", "inv_dim_product")


# First matches of the inputs that repeat their keys.
_FIRST = f"""{with_inputs('inv_inflow', 'inv_outflow', 'inv_repeated_product', 'inv_repeated_header')},
first_product AS (SELECT codigo_producto, min(id_producto) AS id_producto FROM inv_repeated_product GROUP BY codigo_producto),
first_header AS (SELECT codigo, min(CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE)) AS fecha FROM inv_repeated_header GROUP BY codigo)"""


@query("lookup_or_null", f"""{_FIRST}
SELECT codigo, id_producto, count(*) AS filas, CAST(sum(cantidad) AS DOUBLE) AS cantidad
FROM inv_inflow i LEFT JOIN first_product p ON p.codigo_producto = i.codigo GROUP BY codigo, id_producto""")
def _or_null(t: Inputs) -> DataFrame:
    # Rows that share a code are added up before they are looked up.
    per_code = t["inv_inflow"].groupBy("codigo").agg(F.count("*").alias("filas"), F.sum("cantidad").alias("cantidad"))
    return J.lookup_or_null(per_code, "codigo", t["inv_repeated_product"], "codigo_producto", {"id_producto": "id_producto"})


@query("lookup_keep_original", """
WITH side AS (SELECT p_name AS nombre, min(p_partkey) AS id FROM part GROUP BY p_name)
SELECT p_partkey, p_name, id AS id_nombre, CASE WHEN id IS NULL THEN p_name END AS id_nombre_unmatched
FROM part LEFT JOIN side ON nombre = p_name AND p_name NOT LIKE 'small%'""")
def _keep_original(t: Inputs) -> DataFrame:
    part = t.table("part").select("p_partkey", "p_name")
    # The lookup side repeats its keys: the lowest id is the first match. Small goods are not in it.
    side = part.where(~F.col("p_name").startswith("small"))
    return J.lookup_keep_original(part, "p_name", side, "p_name", "p_partkey", "id_nombre", [F.col("p_partkey")])


@query("lookup_in_place", f"""{MOVEMENT_INPUTS}, days AS (
SELECT CAST(d AS DATE) AS dia FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY) g(d))
SELECT serie, CASE WHEN dia IS NOT NULL THEN CAST(dia AS VARCHAR) ELSE fecha END AS fecha
FROM inv_outflow LEFT JOIN days ON dia = CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE)""")
def _in_place(t: Inputs) -> DataFrame:
    # Text dates inside the calendar become ISO dates, the others stay as typed.
    label = F.concat_ws("/", F.dayofmonth("fecha"), F.month("fecha"), F.year("fecha"))
    days = calendar(t.spark, "1997-01-01", "1999-12-31").select(label.alias("texto"), F.col("fecha").cast("string").alias("iso"))
    days = days.unionAll(days.where("iso < '1998-06-01'").select("texto", F.concat("iso", F.lit(" again"))))
    return J.lookup_in_place(t["inv_outflow"].select("serie", "fecha"), "fecha", days, "texto", "iso")


@query("lookup_inner", f"""{_FIRST}
SELECT serie, id_producto, CAST(cantidad AS DOUBLE) AS cantidad FROM inv_outflow o JOIN first_product p ON p.codigo_producto = o.serie""")
def _inner(t: Inputs) -> DataFrame:
    rows = t["inv_outflow"].select("serie", "cantidad")
    return J.lookup_inner(rows, "serie", t["inv_repeated_product"], "codigo_producto", {"id_producto": "id_producto"})


@query("header_detail_join", f"""{_FIRST}
SELECT id_entrada, i.codigo, CAST(cantidad AS DOUBLE) AS cantidad, CAST(h.fecha AS VARCHAR) AS fecha
FROM inv_inflow i LEFT JOIN first_header h ON h.codigo = i.id_entrada""")
def _header_detail(t: Inputs) -> DataFrame:
    return header_detail_join(t["inv_inflow"], dated_headers(t["inv_repeated_header"]))


@query("join_using_dims", f"""{_STAR}
SELECT sk_tiempo, {DAY} AS fecha_completa, c.nombre_categoria, c.tipo_producto, sk_producto,
       CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica
FROM fi JOIN inv_category c USING (sk_categoria)""")
def _using_dims(t: Inputs) -> DataFrame:
    return J.join_dimensions(
        fact(t).select("sk_tiempo", "sk_categoria", "sk_producto", "cantidad_fisica"),
        (t.dates().select("sk_tiempo", "fecha_completa"), "sk_tiempo"), (t["inv_category"], "sk_categoria"),
    ).drop("sk_categoria")


@query("join_composite_key", f"""{_STAR}
SELECT sk_tiempo, sk_producto, CAST(diferencia_unids AS DOUBLE) AS diferencia_unids,
       CASE WHEN diferencia_unids > 0 THEN '+' ELSE '-' END AS signo_diferencia FROM fi WHERE flag_discrepancia""")
def _composite(t: Inputs) -> DataFrame:
    keys = ["sk_tiempo", "sk_producto"]
    inventory, different = stored_facts(t)
    return J.join_keys(inventory.select(*keys, "diferencia_unids"), different.select(*keys, "signo_diferencia"), keys)


@query("star_join_5", f"""{_STAR}
SELECT sk_tiempo, p.nk_codigo_producto, c.nombre_categoria, b.nombre_marca, d.nombre_tipo,
       CAST(abs(diferencia_unids) AS DOUBLE) AS unidades_diferencia
FROM fi JOIN inv_dim_product p USING (sk_producto) JOIN inv_category c ON c.sk_categoria = fi.sk_categoria
JOIN inv_brand b ON b.sk_marca = fi.sk_marca JOIN causes d USING (nk_tipo_disc) WHERE flag_discrepancia""")
def _star_join(t: Inputs) -> DataFrame:
    keys = ["sk_tiempo", "sk_producto"]
    inventory, different = stored_facts(t)
    both = J.join_keys(inventory.select(*keys, "sk_categoria", "sk_marca"),
                       different.select(*keys, "sk_tipo_disc", "unidades_diferencia"), keys)
    return J.join_dimensions(
        both, (products(t).select("sk_producto", "nk_codigo_producto"), "sk_producto"),
        (t["inv_category"].select("sk_categoria", "nombre_categoria"), "sk_categoria"),
        (t["inv_brand"].select("sk_marca", "nombre_marca"), "sk_marca"),
        (t.causes().select("sk_tipo_disc", "nombre_tipo"), "sk_tipo_disc"),
    ).drop("sk_producto", "sk_categoria", "sk_marca", "sk_tipo_disc")


@query("join_on_attribute", f"""{_STAR}
SELECT a.nk_codigo_producto, b.sk_producto FROM inv_dim_product a
JOIN inv_dim_product b ON b.nombre_producto = a.nombre_producto AND b.es_registro_activo WHERE a.dias_para_vencer > 0""")
def _on_attribute(t: Inputs) -> DataFrame:
    left = products(t).where("dias_para_vencer > 0").select("nk_codigo_producto", "nombre_producto")
    right = products(t).where("es_registro_activo").select("sk_producto", "nombre_producto")
    return J.join_keys(left, right, ["nombre_producto"]).drop("nombre_producto")


@query("cross_singletons", f"""{with_inputs('inv_brand', 'inv_category')}
SELECT 'SIN_PRODUCTO' AS nk_codigo_producto, (SELECT sk_marca FROM inv_brand WHERE nombre_marca = 'Brand#7') AS sk_marca,
       (SELECT sk_categoria FROM inv_category WHERE nombre_categoria = 'PROMO') AS sk_categoria""")
def _singletons(t: Inputs) -> DataFrame:
    brand = t["inv_brand"].where(F.col("nombre_marca") == "Brand#7").select("sk_marca")
    category = t["inv_category"].where(F.col("nombre_categoria") == "PROMO").select("sk_categoria")
    unknown = unknown_members(t.spark)["dim_producto"].select("nk_codigo_producto").scalar()
    return J.cross_singletons(brand, category).select(unknown.alias("nk_codigo_producto"), "sk_marca", "sk_categoria")


@query("scalar_subquery", f"""{_STAR}
SELECT (SELECT max(sk_tiempo) FROM fi) AS ultima_toma, nombre_marca, {pct('count(*)', '(SELECT count(*) FROM fi)')} AS pct_filas
FROM fi GROUP BY nombre_marca""")
def _scalar(t: Inputs) -> DataFrame:
    rows = fact(t)
    last = rows.agg(F.max("sk_tiempo")).scalar()
    every = rows.agg(F.count("*")).scalar()
    per_brand = rows.groupBy("sk_marca").agg(F.count("*").alias("n")).join(
        t["inv_brand"].select("sk_marca", "nombre_marca"), "sk_marca")
    return per_brand.select(last.alias("ultima_toma"), "nombre_marca", ratio_pct(F.col("n"), every).alias("pct_filas"))


@query("join_log_header", f"""{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX}, {LOADS}
SELECT m.id_carga, m.fila_excel, l.hoja_procesada, l.periodo_datos, l.estado FROM lots_kind m JOIN loads l ON l.id_carga = m.id_carga""")
def _log_header(t: Inputs) -> DataFrame:
    return J.join_keys(t.sheet("lotes").select("id_carga", "fila_excel"),
                       loads(t).select("id_carga", "hoja_procesada", "periodo_datos", "estado"), ["id_carga"])


@query("anti_join_new_keys", f"""{with_inputs('inv_product_v1', 'inv_product_v2')}
SELECT id, nombre FROM inv_product_v2 WHERE id NOT IN (SELECT id FROM inv_product_v1)""")
def _anti(t: Inputs) -> DataFrame:
    return anti_join_new_keys(t["inv_product_v2"].select("id", "nombre"), t["inv_product_v1"], ["id"])


@query("union_all", f"""{_STAR}
SELECT nombre_marca, count(*) AS filas FROM fi WHERE {ONE_COUNT} GROUP BY nombre_marca
UNION ALL SELECT 'TOTAL GLOBAL', count(*) FROM fi WHERE {ONE_COUNT}""")
def _union(t: Inputs) -> DataFrame:
    per_brand = fact(t, True).groupBy("sk_marca").agg(F.count("*").alias("filas"))
    detail = J.join_dimensions(per_brand, (t["inv_brand"], "sk_marca")).select("nombre_marca", "filas")
    return detail.unionByName(detail.agg(F.lit("TOTAL GLOBAL").alias("nombre_marca"), F.sum("filas").alias("filas")))


@query("append_two_flows", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT id_tipo_mov, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento, id_producto, CAST(cantidad AS DOUBLE) AS cantidad FROM moves""")
def _append(t: Inputs) -> DataFrame:
    master = t["inv_product"]
    return append_two_flows(
        movement_rows(inflows(t["inv_inflow"], t["inv_inflow_header"]), "codigo", master),
        movement_rows(outflows(t["inv_outflow"]), "serie", master))
