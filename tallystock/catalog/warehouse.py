"""Rules, masters, movements, facts, dimensions, versions and control tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import AS_OF, COUNT_KEY, Inputs, with_inputs
from tallystock.catalog.registry import query
from tallystock.catalog.reports import LIGHT, MOVEMENT_INPUTS, MOVEMENTS, light, movements
from tallystock.catalog.rules_sql import CLASSIFIED, REVIEW
from tallystock.catalog.star_sql import BAND, ONE_COUNT, discrepancy, fact, star_sql
from tallystock.functions.rules import recode_category
from tallystock.operators.lookups import lookup_or_null
from tallystock.plans import history as H
from tallystock.plans import masters as M
from tallystock.plans.movements import control_rows
from tallystock.plans.star import build_fact_inventory, discrepancy_cause, generated_measures, stock_status
from tallystock.plans.versions import VersionedTable
from tallystock.session import new_path
from tallystock.sources.seeds import lights, unknown_members
from tallystock.sources.tables import write_fact

_PRODUCTS = f"{with_inputs('inv_product')}, {CLASSIFIED}"
_STAR = star_sql("inv_brand")


def classified(t: Inputs) -> DataFrame:
    return M.classify_products(t["inv_product"].drop("marca"), "codigo_producto", "nombre")


@query("classify_category", f"{_PRODUCTS} SELECT id_producto, categoria_jerarquizada FROM classified")
def _category(t: Inputs) -> DataFrame:
    return classified(t).select("id_producto", "categoria_jerarquizada")


@query("classify_brand", f"{_PRODUCTS} SELECT id_producto, marca FROM classified")
def _brand(t: Inputs) -> DataFrame:
    return classified(t).select("id_producto", "marca")


@query("classify_unit", f"{_PRODUCTS} SELECT id_producto, unidad FROM classified")
def _unit(t: Inputs) -> DataFrame:
    return classified(t).select("id_producto", "unidad")


@query("extract_presentation", f"{_PRODUCTS} SELECT id_producto, presentacion FROM classified")
def _presentation(t: Inputs) -> DataFrame:
    return classified(t).select("id_producto", "presentacion")


@query("manual_review", f"{_PRODUCTS} SELECT id_producto, {REVIEW} AS revision_manual FROM classified")
def _review(t: Inputs) -> DataFrame:
    return classified(t).select("id_producto", "revision_manual")


@query("generated_measures", f"""{_STAR}
SELECT sk_tiempo, sk_producto, CAST(diferencia_unids AS DOUBLE) AS diferencia_unids, flag_discrepancia, flag_stock_cero FROM fi""")
def _measures(t: Inputs) -> DataFrame:
    made = generated_measures(F.col("cantidad_fisica"), F.col("cantidad_sistema"))
    return t["inv_fact"].select("sk_tiempo", "sk_producto", *[c.alias(n) for n, c in made.items()])


@query("ageing_light", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}, {LIGHT}
SELECT l.id_producto, l.codigo_producto, CAST(ultima_modificacion AS VARCHAR) AS ultima_modificacion, dias_inventariado,
       color_semaforo, id_semaforo, p.sk_marca AS id_marca, p.sk_categoria AS id_categoria
FROM light l JOIN inv_product p USING (id_producto)""")
def _light(t: Inputs) -> DataFrame:
    ids = t["inv_product"].select("id_producto", F.col("sk_marca").alias("id_marca"), F.col("sk_categoria").alias("id_categoria"))
    return light(t, ids)


@query("control_rows", """
SELECT p_partkey AS id_producto, CAST(p_partkey AS VARCHAR) AS codigo_producto, p_name AS nombre, CAST(1000 + p_size AS DOUBLE) AS fisico,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS sistema, CAST(NULL AS DOUBLE) AS diferencia FROM part""")
def _control(t: Inputs) -> DataFrame:
    size = F.col("p_size")
    staging = t.table("part").select(
        F.col("p_partkey").alias("id_stg_inv"), F.col("p_partkey").cast("string").alias("codigo_raw"), F.col("p_name").alias("nombre_raw"),
        F.concat(F.lit("1,"), F.lpad(size.cast("string"), 3, "0")).alias("fisico_raw"),
        F.when(size % 2 == 0, size.cast("string")).otherwise("-").alias("sistema_raw"), F.lit("#REF!").alias("diferencia_raw"))
    return control_rows(staging)


_RECODE = {
    "nk_categoria": """CASE nombre WHEN 'Soluble' THEN 'SO' WHEN 'Granular' THEN 'GR' WHEN 'Otros' THEN 'OT'
  WHEN 'Liquidos' THEN 'LI' WHEN 'Material para Invernaderos' THEN 'MI' WHEN 'Sustrato' THEN 'SU' ELSE 'ND' END""",
    "tipo_producto": """CASE nombre WHEN 'Soluble' THEN 'Solubles' WHEN 'Granular' THEN 'Granulares' WHEN 'Otros' THEN 'Varios'
  WHEN 'Liquidos' THEN 'Liquido' WHEN 'Material para Invernaderos' THEN 'Materiales' WHEN 'Sustrato' THEN 'Sustratos'
  WHEN 'Sin Categoría' THEN 'Categoría no definida o no identificada.' ELSE '' END""",
    "descripcion": """CASE nombre WHEN 'Soluble' THEN 'Productos fertilizantes solubles.'
  WHEN 'Granular' THEN 'Productos fertilizantes granulares.'
  WHEN 'Otros' THEN 'Productos que no pertenecen a una categoría específica.'
  WHEN 'Liquidos' THEN 'Fertilizantes, bioestimulantes y productos líquidos.'
  WHEN 'Material para Invernaderos' THEN 'Materiales para invernaderos, coberturas, bandejas y accesorios.'
  WHEN 'Sustrato' THEN 'Sustratos y medios de crecimiento para cultivos.'
  WHEN 'Sin Categoría' THEN 'Categoría no definida o no identificada.' ELSE '' END""",
}
_RECODED = ", ".join(f"{sql} AS {alias}" for alias, sql in _RECODE.items())


@query("recode_category", f"""{_PRODUCTS}, n AS (
SELECT id_producto, CASE WHEN id_producto % 40 = 0 THEN 'Sin Categoría' ELSE categoria_jerarquizada END AS nombre FROM classified)
SELECT id_producto, {_RECODED} FROM n""")
def _recode(t: Inputs) -> DataFrame:
    named = classified(t).select("id_producto", F.when(F.col("id_producto") % 40 == 0, "Sin Categoría").otherwise(
        F.col("categoria_jerarquizada")).alias("nombre"))
    made = recode_category(F.col("nombre"))
    return named.select("id_producto", made["codigo_categoria"].alias("nk_categoria"), made["tipo_producto"].alias("tipo_producto"),
                        made["descripcion"].alias("descripcion"))


_VERSIONS = f"""{with_inputs('inv_product_v1', 'inv_product_v2')}, pairs AS (
SELECT a.id AS old_id, b.id AS new_id, a.nombre, a.presentacion, a.fecha_vencimiento, b.nombre AS n2, b.presentacion AS p2,
       b.fecha_vencimiento AS f2, CASE WHEN a.id IS NULL THEN 'new' WHEN b.id IS NULL THEN 'absent'
         WHEN a.nombre IS DISTINCT FROM b.nombre OR a.presentacion IS DISTINCT FROM b.presentacion
           OR a.fecha_vencimiento IS DISTINCT FROM b.fecha_vencimiento THEN 'changed' ELSE 'same' END AS cambio
FROM inv_product_v1 a FULL JOIN inv_product_v2 b ON a.id = b.id)"""


@query("scd2_merge", f"""{_VERSIONS}
SELECT old_id AS sk_producto, old_id AS id, nombre, presentacion, CAST(fecha_vencimiento AS VARCHAR) AS fecha_vencimiento,
       '2001-01-01' AS fecha_inicio_vigencia, CASE WHEN cambio = 'changed' THEN '2001-12-30' ELSE '9999-12-31' END AS fecha_fin_vigencia,
       cambio <> 'changed' AS es_registro_activo FROM pairs WHERE cambio <> 'new'
UNION ALL SELECT (SELECT max(id) FROM inv_product_v1) + row_number() OVER (ORDER BY new_id), new_id, n2, p2,
       CAST(f2 AS VARCHAR), '{AS_OF}', '9999-12-31', true FROM pairs WHERE cambio IN ('new', 'changed')""")
def _scd2(t: Inputs) -> DataFrame:
    return H.scd2_merge(H.first_versions(t["inv_product_v1"], "2001-01-01"), t["inv_product_v2"], AS_OF)


# Three loads in a row: the first state, the second, the first again. A product's version begins with each load that brings
# another value than the load before that had it.
@query("versioned_loads", f"""{with_inputs('inv_product_v1', 'inv_product_v2')}, loads AS (
  SELECT 1 AS n, DATE '2001-01-01' AS dia, * FROM inv_product_v1 UNION ALL SELECT 2, DATE '{AS_OF}', * FROM inv_product_v2
  UNION ALL SELECT 3, DATE '2002-06-30', * FROM inv_product_v1),
begun AS (SELECT * FROM (SELECT *, lag(nombre) OVER w AS n0, lag(presentacion) OVER w AS p0, lag(fecha_vencimiento) OVER w AS f0,
    row_number() OVER w AS r FROM loads WINDOW w AS (PARTITION BY id ORDER BY n)) x
  WHERE r = 1 OR nombre IS DISTINCT FROM n0 OR presentacion IS DISTINCT FROM p0 OR fecha_vencimiento IS DISTINCT FROM f0)
SELECT row_number() OVER (ORDER BY n, id) AS sk_producto, id, nombre, presentacion, CAST(fecha_vencimiento AS VARCHAR) AS fecha_vencimiento,
       CAST(dia AS VARCHAR) AS fecha_inicio_vigencia, coalesce(CAST(CAST(lead(dia) OVER v - INTERVAL 1 DAY AS DATE) AS VARCHAR), '9999-12-31') AS fecha_fin_vigencia,
       lead(dia) OVER v IS NULL AS es_registro_activo
FROM begun WINDOW v AS (PARTITION BY id ORDER BY n)""")
def _versioned(t: Inputs) -> DataFrame:
    table = VersionedTable(t.spark, new_path(t.spark, "dim-producto"))
    for state, day in (("inv_product_v1", "2001-01-01"), ("inv_product_v2", AS_OF), ("inv_product_v1", "2002-06-30")):
        table.load(t[state], day)
    return table.versions()


@query("expiry_band", f"{with_inputs('inv_dim_product')} SELECT sk_producto, dias_para_vencer, {BAND} AS clasificacion_venc FROM inv_dim_product WHERE sk_producto <> -1")
def _band(t: Inputs) -> DataFrame:
    dated = t["inv_product"].select(F.col("id_producto").alias("sk_producto"), "fecha_vencimiento")
    return H.overwrite_expiry(dated, AS_OF).select("sk_producto", "dias_para_vencer", "clasificacion_venc")


@query("stock_status", f"{_STAR} SELECT sk_tiempo, sk_producto, nk_estado FROM fi")
def _status(t: Inputs) -> DataFrame:
    return t["inv_fact"].select("sk_tiempo", "sk_producto", stock_status(F.col("cantidad_fisica"), F.col("cantidad_sistema")).alias("nk_estado"))


@query("discrepancy_cause", f"{_STAR} SELECT sk_tiempo, sk_producto, nk_tipo_disc FROM fi")
def _cause(t: Inputs) -> DataFrame:
    gap = F.col("cantidad_fisica") - F.col("cantidad_sistema")
    return t["inv_fact"].select("sk_tiempo", "sk_producto", discrepancy_cause(gap, F.col("observacion_texto")).alias("nk_tipo_disc"))


@query("build_fact_inventory", f"""{_STAR}, {MOVEMENT_INPUTS.removeprefix('WITH ')}, {MOVEMENTS}, {LIGHT}
SELECT sk_tiempo, sk_producto, sk_categoria, sk_marca, sk_estado_stock, l.id_semaforo AS sk_tipo_semaforo,
       dias_inventariado AS dias_inventariados, CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica,
       CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema, CAST(diferencia_unids AS DOUBLE) AS diferencia_unids,
       flag_discrepancia, flag_stock_cero, 7 AS id_carga_origen
FROM fi JOIN states USING (nk_estado) LEFT JOIN light l ON l.id_producto = fi.sk_producto""")
def _fact(t: Inputs) -> DataFrame:
    lit = lookup_or_null(t["inv_fact"], "sk_producto", light(t), "id_producto",
                         {"id_semaforo": "sk_tipo_semaforo", "dias_inventariado": "dias_inventariados"}, unique=True)
    return build_fact_inventory(lit, load_id=7)


@query("write_fact", f"""{_STAR}
SELECT sk_tiempo, sk_producto, CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica, CAST(diferencia_unids AS DOUBLE) AS diferencia_unids
FROM fi""")
def _write_fact(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "fact")
    rows = fact(t)
    # Two loads in turn: the second one must leave the counts of the first.
    write_fact(rows.where(F.col("sk_tiempo") != COUNT_KEY), path)
    write_fact(rows.where(F.col("sk_tiempo") == COUNT_KEY), path)
    return t.spark.read.parquet(path).select(
        "sk_tiempo", "sk_producto", "cantidad_fisica", "diferencia_unids")


@query("build_fact_discrepancy", f"""{_STAR}
SELECT sk_tiempo, sk_producto, sk_categoria, sk_marca, sk_tipo_disc, CAST(abs(diferencia_unids) AS DOUBLE) AS unidades_diferencia,
       CASE WHEN diferencia_unids > 0 THEN '+' ELSE '-' END AS signo_diferencia, CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica,
       CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema, observacion_texto, 0 AS id_carga_origen
FROM fi JOIN causes USING (nk_tipo_disc) WHERE flag_discrepancia""")
def _fact_discrepancy(t: Inputs) -> DataFrame:
    return discrepancy(t)


_MASTERS = f"""{_PRODUCTS}, seen AS (
SELECT 'categoria_jerarquizada' AS columna, categoria_jerarquizada AS valor, min(id_producto) AS f FROM classified GROUP BY 2
UNION ALL SELECT 'unidad', unidad, min(id_producto) FROM classified GROUP BY 2
UNION ALL SELECT 'marca', marca, min(id_producto) FROM classified GROUP BY 2),
master AS (SELECT columna, valor, f AS primera_fila, CAST(row_number() OVER (PARTITION BY columna ORDER BY f, valor) AS INT) AS id FROM seen)"""


@query("build_masters", f"{_MASTERS} SELECT columna, valor, primera_fila, id FROM master")
def _masters(t: Inputs) -> DataFrame:
    return M.master_values(classified(t), "id_producto")


@query("build_product_master", f"""{_MASTERS}
SELECT id_producto, codigo_producto, nombre, presentacion, c.id AS id_categoria, m.id AS id_marca, u.id AS id_unidad
FROM classified p LEFT JOIN master c ON c.columna = 'categoria_jerarquizada' AND c.valor = p.categoria_jerarquizada
LEFT JOIN master m ON m.columna = 'marca' AND m.valor = p.marca LEFT JOIN master u ON u.columna = 'unidad' AND u.valor = p.unidad""")
def _product_master(t: Inputs) -> DataFrame:
    rows = classified(t)
    return M.build_product_master(rows, M.stored_master_values(rows, "id_producto"), "id_producto", "codigo_producto", "nombre")


@query("build_dims", f"""{_MASTERS}, cats AS (SELECT id, valor AS nombre FROM master WHERE columna = 'categoria_jerarquizada')
SELECT 'dim_categoria' AS dimension, id AS sk, nk_categoria AS nk, nombre, tipo_producto AS detalle FROM (SELECT id, nombre, {_RECODED} FROM cats) x
UNION ALL SELECT 'dim_marca', id, valor, valor, '' FROM master WHERE columna = 'marca'
UNION ALL SELECT 'dim_producto', CAST(id_producto AS INT), codigo_producto, nombre, coalesce(presentacion, '') FROM classified
UNION ALL SELECT 'dim_tiempo', CAST(strftime(d, '%Y%m%d') AS INT), CAST(CAST(d AS DATE) AS VARCHAR), 'S' || lpad(CAST(week(d) AS VARCHAR), 2, '0') || '-' || year(d),
       'Q' || quarter(d) || '-' || year(d) FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)
UNION ALL SELECT * FROM (VALUES ('dim_tipo_semaforo', 1, 'Verde', 'Verde', 'Hasta 90 días'), ('dim_tipo_semaforo', 2, 'Amarillo', 'Amarillo', 'De 91 a 365 días'),
  ('dim_tipo_semaforo', 3, 'Rojo', 'Rojo', 'Más de 365 días'), ('dim_tipo_semaforo', 4, 'Revisión', 'Revisión', 'Sin entrada'),
  ('dim_categoria', -1, 'ND', 'Sin Categoría', 'Desconocido'), ('dim_marca', -1, 'SIN_MARCA', 'Sin Marca Definida', ''),
  ('dim_producto', -1, 'SIN_PRODUCTO', 'Producto Sin Definir', ''), ('dim_tiempo', -1, '1900-01-01', 'N/A', 'N/A')) v""")
def _dims(t: Inputs) -> DataFrame:
    rows = classified(t)
    values = M.stored_master_values(rows, "id_producto")
    goods = M.product_dimension(M.build_product_master(rows, values, "id_producto", "codigo_producto", "nombre"))
    categories = M.master_table(values, "categoria_jerarquizada", "id_categoria", "nombre")
    brands = M.master_table(values, "marca", "id_marca", "nombre_marca")
    colours = M.light_dimension(lights(t.spark).toDF("id_semaforo", "color", "rango"))

    def shape(df: DataFrame, dimension: str, sk: str, nk: str, name: str, detail: Column) -> DataFrame:
        return df.select(F.lit(dimension).alias("dimension"), F.col(sk).cast("int").alias("sk"),
                         F.col(nk).cast("string").alias("nk"), F.col(name).alias("nombre"), detail.alias("detalle"))

    parts = [
        shape(M.category_dimension(categories), "dim_categoria", "sk_categoria", "nk_categoria",
              "nombre_categoria", F.col("tipo_producto")),
        shape(M.brand_dimension(brands), "dim_marca", "sk_marca", "nk_marca", "nombre_marca", F.lit("")),
        shape(goods, "dim_producto", "sk_producto", "nk_codigo_producto", "nombre_producto",
              F.coalesce("presentacion", F.lit(""))),
        shape(t.dates(), "dim_tiempo", "sk_tiempo", "fecha_completa", "nombre_semana", F.col("nombre_trimestre")),
        shape(colours, "dim_tipo_semaforo", "id_tipo_semaforo", "color_semaforo", "color_semaforo", F.col("rango_descripcion")),
    ]
    # The rows that facts without a known key point to; the calendar has its own.
    unknown = unknown_members(t.spark)
    parts += [
        shape(unknown["dim_categoria"], "dim_categoria", "sk_categoria", "nk_categoria", "nombre_categoria", F.col("tipo_producto")),
        shape(unknown["dim_marca"], "dim_marca", "sk_marca", "nk_marca", "nombre_marca", F.lit("")),
        shape(unknown["dim_producto"], "dim_producto", "sk_producto", "nk_codigo_producto", "nombre_producto", F.lit("")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("build_movements", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT id_producto, id_tipo_mov, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento, CAST(cantidad AS DOUBLE) AS cantidad FROM moves""")
def _movements(t: Inputs) -> DataFrame:
    return movements(t)


@query("change_journal", f"""{_VERSIONS}, j AS (SELECT *, CASE cambio WHEN 'new' THEN 'INSERT' WHEN 'absent' THEN 'DELETE' ELSE 'UPDATE' END AS operacion
FROM pairs WHERE cambio <> 'same')
SELECT 'producto' AS tabla, operacion, CAST(coalesce(new_id, old_id) AS VARCHAR) AS id_registro,
       CAST(CASE WHEN operacion <> 'INSERT' THEN nombre END AS VARCHAR) AS nombre_antes,
       CAST(CASE WHEN operacion <> 'DELETE' THEN n2 END AS VARCHAR) AS nombre_despues,
       CASE WHEN operacion <> 'INSERT' THEN CAST(fecha_vencimiento AS VARCHAR) END AS vence_antes,
       CASE WHEN operacion <> 'DELETE' THEN CAST(f2 AS VARCHAR) END AS vence_despues FROM j""")
def _journal(t: Inputs) -> DataFrame:
    journal = H.change_journal(t["inv_product_v1"], t["inv_product_v2"], "producto")
    return journal.select(
        "tabla", "operacion", "id_registro",
        *[F.get_json_object(f"valores_{when}", f"$.{field}").alias(f"{short}_{when}")
          for short, field in [("nombre", "nombre"), ("vence", "fecha_vencimiento")] for when in ["antes", "despues"]])


@query("stamp_modified", f"""{_VERSIONS}
SELECT new_id AS id, CASE WHEN cambio = 'same' THEN '2001-01-01' ELSE '{AS_OF}' END AS modificado_en FROM pairs WHERE new_id IS NOT NULL""")
def _stamp(t: Inputs) -> DataFrame:
    stored = t["inv_product_v1"].withColumn("modificado_en", F.lit("2001-01-01").cast("date"))
    return H.stamp_modified(stored, t["inv_product_v2"], "modificado_en", AS_OF).select("id", "modificado_en")


_CONTROL = f"""{with_inputs('inv_control')}, current AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY nombre_proceso ORDER BY total_cargas DESC) AS r FROM inv_control) x WHERE r = 1),
mark AS (SELECT max(ultima_fecha_dato) AS m FROM inv_control WHERE nombre_proceso = 'ETL_FACT_INVENTARIO' AND estado_ultimo = 'Completado')"""


@query("incremental_rows", f"""{_CONTROL}
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS fecha FROM lineitem, mark WHERE CAST(l_shipdate AS DATE) > m""")
def _incremental(t: Inputs) -> DataFrame:
    rows = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    fresh = H.incremental_rows(rows, "l_shipdate", t["inv_control"], "ETL_FACT_INVENTARIO")
    return fresh.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("fecha"))


@query("incremental_watermark", f"""{_CONTROL}
SELECT nombre_proceso, total_cargas + CASE WHEN nombre_proceso = 'ETL_FACT_INVENTARIO' THEN 1 ELSE 0 END AS total_cargas,
       CASE WHEN nombre_proceso = 'ETL_FACT_INVENTARIO' THEN 'Completado' ELSE estado_ultimo END AS estado_ultimo,
       CAST(CASE WHEN nombre_proceso = 'ETL_FACT_INVENTARIO' THEN (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)
                 ELSE ultima_fecha_dato END AS VARCHAR) AS ultima_fecha_dato FROM current""")
def _watermark(t: Inputs) -> DataFrame:
    control = t["inv_control"]
    fresh = H.incremental_rows(t.table("lineitem").select("l_shipdate"), "l_shipdate", control, "ETL_FACT_INVENTARIO")
    fresh = fresh.select(F.to_date("l_shipdate").alias("fecha"))
    return H.move_mark(H.latest_marks(control), fresh, "fecha", "ETL_FACT_INVENTARIO")


@query("process_log", f"""{_VERSIONS}, o AS (SELECT cambio, coalesce(new_id, old_id) % 50 = 0 AS bad FROM pairs)
SELECT 'SCD2' AS proceso, 'DIM_PRODUCTO' AS tabla_afectada, count(*) FILTER (NOT bad AND cambio IN ('new', 'changed')) AS filas_insertadas,
       count(*) FILTER (NOT bad AND cambio = 'changed') AS filas_actualizadas, count(*) FILTER (NOT bad AND cambio = 'absent') AS filas_eliminadas,
       count(*) FILTER (bad) AS filas_rechazadas, CAST(12.345 AS DOUBLE) AS duracion_seg,
       CASE WHEN count(*) FILTER (bad) > 0 THEN 'Advertencia' ELSE 'Completado' END AS estado FROM o""")
def _process_log(t: Inputs) -> DataFrame:
    compared = H.compare(H.first_versions(t["inv_product_v1"], "2001-01-01"), t["inv_product_v2"])
    outcome = compared.select("cambio", (F.coalesce("n.id", "o.id") % 50 == 0).alias("rechazada"))
    start, end = [F.lit(f"2001-12-31 10:00:{s}").cast("timestamp") for s in ["00", "12.345"]]
    return H.process_log(outcome, "SCD2", "DIM_PRODUCTO", start, end)
