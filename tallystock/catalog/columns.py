"""Column list operators and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import COUNT_KEY, Inputs, with_inputs
from tallystock.catalog.quality_sql import CATALOGUE, KARDEX, LOADS, LOTS, MAIN, SHEET_INPUTS, loads
from tallystock.catalog.registry import query
from tallystock.catalog.reports import MOVEMENT_INPUTS, MOVEMENTS, movements
from tallystock.catalog.star_sql import ONE_COUNT, fact, products, star_sql
from tallystock.functions.rules import recode_category
from tallystock.operators import columns as C
from tallystock.operators import filters as R
from tallystock.plans.movements import outflows
from tallystock.plans.quality import land, ready_rows

_FACT = star_sql()
_Q = "CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica, CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema"


@query("keep_columns", f"{with_inputs('inv_fact')} SELECT sk_tiempo, sk_producto, {_Q} FROM inv_fact")
def _keep(t: Inputs) -> DataFrame:
    return C.keep_columns(t["inv_fact"], ["sk_tiempo", "sk_producto", "cantidad_fisica", "cantidad_sistema"])


@query("remove_columns", f"""{with_inputs('inv_fact')}
SELECT sk_tiempo, sk_producto, sk_categoria, sk_marca, {_Q} FROM inv_fact""")
def _remove(t: Inputs) -> DataFrame:
    return C.remove_columns(t["inv_fact"], ["nombre_categoria", "nombre_marca", "observacion_texto"])


@query("rename_columns", f"""{with_inputs('inv_inflow')}
SELECT id_entrada, codigo AS "CodigoProducto", CAST(cantidad AS DOUBLE) AS cantidad FROM inv_inflow""")
def _rename(t: Inputs) -> DataFrame:
    return C.rename_columns(t["inv_inflow"], {"codigo": "CodigoProducto"})


@query("reorder_columns", f"""{with_inputs('inv_fact')}
SELECT sk_tiempo, sk_producto, sk_marca, sk_categoria, {_Q} FROM inv_fact""")
def _reorder(t: Inputs) -> DataFrame:
    kept = t["inv_fact"].select("sk_tiempo", "sk_producto", "sk_categoria", "sk_marca", "cantidad_sistema",
                                "cantidad_fisica")
    return C.reorder_columns(kept, [("sk_marca", "sk_producto"), ("cantidad_fisica", "sk_categoria")])


@query("add_columns", f"""{with_inputs('inv_fact')}, d AS (
SELECT sk_tiempo, sk_producto, cantidad_fisica - cantidad_sistema AS diferencia FROM inv_fact)
SELECT sk_tiempo, sk_producto, CAST(diferencia AS DOUBLE) AS diferencia, CAST(abs(diferencia) AS DOUBLE) AS magnitud,
       CASE WHEN abs(diferencia) > 10 THEN 'REVISAR' ELSE 'OK' END AS revision,
       sk_producto + 1 AS "sk_producto 2" FROM d""")
def _add(t: Inputs) -> DataFrame:
    counts = t["inv_fact"].select("sk_tiempo", "sk_producto", "cantidad_fisica", "cantidad_sistema")
    return C.add_columns(counts, {
        "diferencia": F.col("cantidad_fisica") - F.col("cantidad_sistema"),
        "magnitud": F.abs("diferencia"),
        "revision": F.when(F.col("magnitud") > 10, "REVISAR").otherwise("OK"),
        "sk_producto": F.col("sk_producto") + 1,  # taken: becomes "sk_producto 2"
    }).drop("cantidad_fisica", "cantidad_sistema")


@query("replace_columns", f"""{with_inputs('inv_product')}
SELECT id_producto, CASE categoria_raw WHEN 'Liquidos' THEN 'LI' ELSE 'ND' END AS categoria_raw,
       upper(marca) AS marca FROM inv_product""")
def _replace(t: Inputs) -> DataFrame:
    kept = t["inv_product"].select("id_producto", "categoria_raw", "marca")
    return C.replace_columns(kept, {
        "categoria_raw": recode_category(F.col("categoria_raw"))["codigo_categoria"], "marca": F.upper("marca")})


@query("derive_branch", f"""{_FACT}
SELECT 'faltante' AS rama, sk_tiempo, count(*) AS n FROM fi WHERE diferencia_unids < 0 GROUP BY sk_tiempo
UNION ALL SELECT 'sobrante', sk_tiempo, count(*) FROM fi WHERE diferencia_unids > 0 GROUP BY sk_tiempo
UNION ALL SELECT 'exacto', sk_tiempo, count(*) FROM fi WHERE diferencia_unids = 0 GROUP BY sk_tiempo""")
def _derive(t: Inputs) -> DataFrame:
    d = F.col("diferencia_unids")
    branches = C.derive_branches(fact(t), {
        name: lambda df, name=name, p=p: df.where(p).groupBy(F.lit(name).alias("rama"), "sk_tiempo").agg(
            F.count("*").alias("n"))
        for name, p in {"faltante": d < 0, "sobrante": d > 0, "exacto": d == 0}.items()})
    first, second, third = branches.values()
    return first.unionByName(second).unionByName(third)


@query("drop_empty_rows", f"""{SHEET_INPUTS}, {MAIN}
SELECT id_carga, fila_excel, codigo_raw, nombre_raw FROM main_kind WHERE tipo_fila <> 'vacia'""")
def _empty(t: Inputs) -> DataFrame:
    return R.drop_empty_rows(t.sheet("principal"), "principal").select("id_carga", "fila_excel", "codigo_raw", "nombre_raw")


@query("drop_header_rows", f"""{SHEET_INPUTS}, {MAIN}
SELECT id_carga, fila_excel, codigo_raw, nombre_raw FROM main_kind
WHERE lower(ltrim(coalesce(codigo_raw, ''), '''')) NOT IN ('codigo', 'código', 'cod', 'code', 'tipo')""")
def _header(t: Inputs) -> DataFrame:
    return R.drop_header_rows(t.sheet("principal"), "principal").select("id_carga", "fila_excel", "codigo_raw", "nombre_raw")


@query("ready_rows_main", f"""{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX}, {LOADS}
SELECT m.id_carga, l.periodo_datos, ltrim(coalesce(codigo_raw, ''), '''') AS codigo_limpio,
       trim(nombre_raw) AS nombre_limpio, trim(fisico_raw) AS fisico_raw, trim(sistema_raw) AS sistema_raw,
       trim(diferencia_raw) AS diferencia_raw, trim(observacion_raw) AS observacion_raw, categoria_raw, fila_excel
FROM main_landed m JOIN loads l ON l.id_carga = m.id_carga WHERE lnd_listo_para_stg""")
def _ready_main(t: Inputs) -> DataFrame:
    return ready_rows(land(t.sheet("principal"), "principal"), loads(t), "principal")


@query("ready_rows_lots", f"""{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX}, {LOADS}
SELECT m.id_carga, l.periodo_datos, ltrim(coalesce(lote_raw, ''), '''') AS lote_limpio,
       ltrim(coalesce(codigo_raw, ''), '''') AS codigo_limpio, trim(nombre_raw) AS nombre_limpio,
       trim(fisico_raw) AS fisico_raw, trim(sistema_raw) AS sistema_raw, trim(diferencia_raw) AS diferencia_raw,
       trim(observacion_raw) AS observacion_raw, trim(estado_lote_raw) AS estado_lote_raw,
       trim(fecha_venc_raw) AS fecha_venc_raw, trim(almacenaje_raw) AS almacenaje_raw, fila_excel,
       lnd_fecha_venc_parseable
FROM lots_landed m JOIN loads l ON l.id_carga = m.id_carga WHERE lnd_listo_para_stg""")
def _ready_lots(t: Inputs) -> DataFrame:
    return ready_rows(land(t.sheet("lotes"), "lotes"), loads(t), "lotes")


_MOVE_OUT = """id_producto, id_tipo_mov, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento,
CAST(cantidad AS DOUBLE) AS cantidad"""


@query("keep_values", f"{MOVEMENT_INPUTS}, {MOVEMENTS} SELECT {_MOVE_OUT} FROM moves WHERE id_tipo_mov = 1")
def _keep_values(t: Inputs) -> DataFrame:
    return R.keep_values(movements(t), "id_tipo_mov", [1])


@query("remove_values", f"""{MOVEMENT_INPUTS}, n AS (
SELECT codigo, CASE WHEN id_entrada % 20 = 0 THEN NULL ELSE cantidad END AS cantidad FROM inv_inflow)
SELECT codigo, CAST(cantidad AS DOUBLE) AS cantidad FROM n
WHERE cantidad IS NULL OR cantidad NOT IN (1, 2, 2.5, 3, 4, 5)""")
def _remove_values(t: Inputs) -> DataFrame:
    rows = t["inv_inflow"].select("codigo", F.when(F.col("id_entrada") % 20 != 0, F.col("cantidad")).alias("cantidad"))
    return R.remove_values(rows, "cantidad", [1, 2, 2.5, 3, 4, 5])


@query("remove_empty_values", f"""{MOVEMENT_INPUTS}
SELECT codigo, id_producto FROM inv_inflow i LEFT JOIN inv_product p ON p.codigo_producto = i.codigo
WHERE id_producto IS NOT NULL""")
def _remove_empty(t: Inputs) -> DataFrame:
    looked = t["inv_inflow"].select("codigo").join(
        t["inv_product"].select("id_producto", "codigo_producto"), F.col("codigo") == F.col("codigo_producto"), "left")
    return R.remove_empty_values(looked, "id_producto").select("codigo", "id_producto")


@query("date_range_filter", f"""{MOVEMENT_INPUTS}, d AS (
SELECT serie, CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE) AS fecha FROM inv_outflow)
SELECT serie, CAST(fecha AS VARCHAR) AS fecha FROM d WHERE fecha >= DATE '1998-01-01' AND fecha < DATE '2000-05-08'""")
def _date_range(t: Inputs) -> DataFrame:
    return R.date_range_filter(outflows(t["inv_outflow"]), "fecha", "1998-01-01", "2000-05-08").select("serie", "fecha")


@query("active_between", f"""{with_inputs('inv_dim_product')}
SELECT sk_producto, nk_codigo_producto, dias_para_vencer, CAST(fecha_vencimiento AS VARCHAR) AS fecha_vencimiento
FROM inv_dim_product WHERE es_registro_activo AND fecha_vencimiento IS NOT NULL AND dias_para_vencer BETWEEN 0 AND 365""")
def _active(t: Inputs) -> DataFrame:
    return R.active_between(products(t)).select("sk_producto", "nk_codigo_producto", "dias_para_vencer", "fecha_vencimiento")


@query("snapshot_filter", f"{_FACT} SELECT sk_tiempo, sk_producto, {_Q} FROM fi WHERE {ONE_COUNT}")
def _snapshot(t: Inputs) -> DataFrame:
    return R.snapshot_filter(fact(t, True), COUNT_KEY).select("sk_tiempo", "sk_producto", "cantidad_fisica", "cantidad_sistema")


@query("positive_stock_filter", f"{_FACT} SELECT sk_tiempo, sk_producto, {_Q} FROM fi WHERE cantidad_fisica > 0")
def _positive(t: Inputs) -> DataFrame:
    return R.positive_stock_filter(fact(t)).select("sk_tiempo", "sk_producto", "cantidad_fisica", "cantidad_sistema")
