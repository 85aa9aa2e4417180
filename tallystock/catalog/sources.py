"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.catalog.inputs import AS_OF, Inputs, with_inputs
from tallystock.catalog.quality_sql import MAIN, SHEET_INPUTS
from tallystock.catalog.registry import query
from tallystock.catalog.reports import MOVEMENT_INPUTS, MOVEMENTS
from tallystock.catalog.rules_sql import CLASSIFIED
from tallystock.catalog.star_sql import discrepancy, fact, star_sql
from tallystock.functions.cells import text_to_date
from tallystock.operators.lookups import lookup_or_null
from tallystock.plans.masters import classify_products
from tallystock.plans.movements import inflows, outflows
from tallystock.plans.quality import land
from tallystock.session import new_path
from tallystock.sources import files as L
from tallystock.sources import seeds as S
from tallystock.sources import sheets as H
from tallystock.sources import tables as T


@query("route_sheets", f"""{with_inputs('inv_workbook')}, alias(orden, hoja, tipo) AS (VALUES
  (0, 'Fertilisa', 'principal'), (1, 'Manvert, Jiffy', 'lotes'), (2, 'Manvert,Jiffy', 'lotes'),
  (3, 'Manvert Jiffy', 'lotes'), (4, 'LISTA DE PRODUCTOS', 'catalogo'), (5, 'EJEMPLO DATOS KARDEX', 'movimientos')),
known AS (SELECT id_archivo, hoja, tipo, row_number() OVER (PARTITION BY id_archivo, tipo ORDER BY orden) AS r
          FROM inv_workbook LEFT JOIN alias USING (hoja))
SELECT id_archivo, hoja, tipo, CASE WHEN tipo IS NULL THEN 'desconocida' WHEN r = 1 THEN 'procesar' ELSE 'repetida' END AS destino
FROM known
UNION ALL
SELECT id_archivo, hoja, CAST(NULL AS VARCHAR), 'ausente' FROM (SELECT DISTINCT id_archivo FROM inv_workbook) w
CROSS JOIN alias a WHERE NOT EXISTS (SELECT 1 FROM inv_workbook x WHERE x.id_archivo = w.id_archivo AND x.hoja = a.hoja)""")
def _route(t: Inputs) -> DataFrame:
    books = t["inv_workbook"]
    missing = H.missing_sheets(books).withColumns({"tipo": F.lit(None).cast("string"), "destino": F.lit("ausente")})
    return H.route_sheets(books).unionByName(missing)


# Files of earlier runs are the log; the others arrive in this run.
_RUN = """logged AS (SELECT hash_md5, 'Procesado' AS estado FROM inv_file WHERE id_archivo_log % 10 = 0),
arrived AS (SELECT * FROM inv_file WHERE id_archivo_log % 10 <> 0),
accepted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash_md5 ORDER BY id_archivo_log) AS r FROM arrived) x
  WHERE r = 1 AND hash_md5 NOT IN (SELECT hash_md5 FROM logged))"""


def _run(t: Inputs) -> tuple[DataFrame, DataFrame]:
    every = t["inv_file"]
    old = F.col("id_archivo_log") % 10 == 0
    log = every.where(old).select("hash_md5", F.lit("Procesado").alias("estado"))
    arrived = every.where(~old)
    return arrived, L.dedupe_files_md5(arrived, log, "id_archivo_log")


@query("dedupe_files_md5", f"""{with_inputs('inv_file')}, {_RUN}
SELECT id_archivo_log, nombre_archivo, hash_md5, caracteres FROM accepted""")
def _dedupe(t: Inputs) -> DataFrame:
    return _run(t)[1]


@query("table_scan", "SELECT p_partkey, p_name, p_brand FROM part")
def _table_scan(t: Inputs) -> DataFrame:
    return T.table_scan(t.spark, t.path("part"), ["p_partkey", "p_name", "p_brand"])


@query("external_erp_scan", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem")
def _external(t: Inputs) -> DataFrame:
    return T.external_scan(t.spark, t.path("lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"],
                           source="parquet")


_OUTFLOW_SET = """SELECT serie, CAST(cantidad AS DOUBLE) AS cantidad, CASE WHEN cantidad > 0 THEN 1 ELSE 2 END AS id_tipo_mov,
CAST(CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE) AS VARCHAR) AS fecha FROM inv_outflow"""


@query("dataset_write", f"{MOVEMENT_INPUTS}, o AS ({_OUTFLOW_SET}) SELECT id_tipo_mov, count(*) AS filas FROM o GROUP BY id_tipo_mov")
def _dataset_write(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "outflows")
    T.dataset_write(outflows(t["inv_outflow"]).drop("fecha_raw"), path, "halt")
    T.dataset_write(outflows(t["inv_outflow"]).drop("fecha_raw"), path, "overwrite")
    return T.dataset_read(t.spark, path).groupBy("id_tipo_mov").agg(F.count("*").alias("filas"))


@query("dataset_read", f"{MOVEMENT_INPUTS} {_OUTFLOW_SET}")
def _dataset_read(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "outflows")
    T.dataset_write(outflows(t["inv_outflow"]).drop("fecha_raw"), path)
    schema = "serie string, cantidad decimal(12,2), fecha date, id_tipo_mov int"
    return T.dataset_read(t.spark, path, schema)


_MOVE_MAP = {"id_producto": ("id_producto", "bigint"), "id_tipo_mov": ("id_tipo_mov", "smallint"),
             "fecha": ("fecha_movimiento", "date"), "cantidad": ("cantidad", "decimal(12,2)")}


@query("mapped_append", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT id_producto, id_tipo_mov, CAST(fecha_movimiento AS VARCHAR) AS fecha_movimiento, CAST(cantidad AS DOUBLE) AS cantidad,
       'etl' AS usuario_registro FROM moves""")
def _mapped_append(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "movements")
    products = t["inv_product"]
    for flow, code in [(inflows(t["inv_inflow"], t["inv_inflow_header"]), "codigo"), (outflows(t["inv_outflow"]), "serie")]:
        found = lookup_or_null(flow, code, products, "codigo_producto", {"id_producto": "id_producto"})
        T.mapped_append(found.where("id_producto IS NOT NULL"), _MOVE_MAP, path, {"usuario_registro": F.lit("etl")})
    return t.spark.read.parquet(path).withColumn("id_tipo_mov", F.col("id_tipo_mov").cast("int"))


@query("bulk_insert", f"""{SHEET_INPUTS}, {MAIN}
SELECT id_archivo, id_carga, fila_excel, codigo_raw, nombre_raw, fisico_raw, sistema_raw, categoria_raw, lnd_listo_para_stg
FROM main_landed""")
def _bulk(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "landing")
    T.bulk_insert(land(t.sheet("principal"), "principal"), path)
    return t.spark.read.parquet(path).select("id_archivo", "id_carga", "fila_excel", "codigo_raw", "nombre_raw",
                                             "fisico_raw", "sistema_raw", "categoria_raw", "lnd_listo_para_stg")


_SEED = ", ".join(f"('{n}', '{c}', '{p}')" for n, c, p in V.BRAND_SEED)


@query("insert_if_absent", f"""{with_inputs('inv_product')}, {CLASSIFIED}, held AS (SELECT DISTINCT marca AS nk_marca FROM classified),
seed(nk_marca, pais_origen, tipo_proveedor) AS (VALUES {_SEED})
SELECT nk_marca, 'Desconocido' AS pais_origen, 'Desconocido' AS tipo_proveedor, FALSE AS es_sin_definir FROM held
UNION ALL SELECT *, FALSE FROM seed WHERE nk_marca NOT IN (SELECT nk_marca FROM held)""")
def _insert_absent(t: Inputs) -> DataFrame:
    classified = classify_products(t["inv_product"].drop("marca"), "codigo_producto", "nombre")
    held = classified.select(F.col("marca").alias("nk_marca")).distinct().withColumns(
        {"pais_origen": F.lit("Desconocido"), "tipo_proveedor": F.lit("Desconocido"), "es_sin_definir": F.lit(False)})
    return T.insert_if_absent(held, S.brand_seed(t.spark).drop("nombre_marca"), "nk_marca")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


@query("literal_table", f"""{star_sql()}, about(sk, nk_estado, nombre, descripcion, es_disponible, requiere_accion, color) AS (
  VALUES {_values(V.STOCK_STATES)})
SELECT s.nk_estado, s.nombre_estado, s.color_semaforo, descripcion, es_disponible, requiere_accion, count(f.sk_producto) AS filas
FROM states s JOIN about a USING (nk_estado) LEFT JOIN fi f USING (nk_estado) GROUP BY ALL""")
def _literal(t: Inputs) -> DataFrame:
    used = fact(t).groupBy("sk_estado_stock").agg(F.count("*").alias("filas"))
    return S.stock_states(t.spark).join(used, "sk_estado_stock", "left").select(
        "nk_estado", "nombre_estado", "color_semaforo", "descripcion", "es_disponible", "requiere_accion",
        F.coalesce("filas", F.lit(0).cast("bigint")).alias("filas"))


@query("seed_causes", f"""{star_sql()}, about(sk, nk_tipo_disc, nombre, descripcion, impacto, afecta_activos, accion_recomendada) AS (
  VALUES {_values(V.DISCREPANCY_TYPES)})
SELECT c.nk_tipo_disc, c.nombre_tipo, c.impacto_financiero, descripcion, afecta_activos, accion_recomendada,
       count(f.sk_producto) AS filas, coalesce(CAST(sum(abs(diferencia_unids)) AS DOUBLE), 0) AS unidades
FROM causes c JOIN about a USING (nk_tipo_disc) LEFT JOIN fi f ON f.nk_tipo_disc = c.nk_tipo_disc AND flag_discrepancia GROUP BY ALL""")
def _causes(t: Inputs) -> DataFrame:
    used = discrepancy(t).groupBy("sk_tipo_disc").agg(F.count("*").alias("filas"), F.sum("unidades_diferencia").alias("unidades"))
    return t.causes().join(used, "sk_tipo_disc", "left").select(
        "nk_tipo_disc", "nombre_tipo", "impacto_financiero", "descripcion", "afecta_activos", "accion_recomendada",
        F.coalesce("filas", F.lit(0).cast("bigint")).alias("filas"), F.coalesce("unidades", F.lit(0)).alias("unidades"))


@query("calendar", f"""{with_inputs('inv_outflow')}, days AS (
SELECT CAST(d AS DATE) AS fecha FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)),
moved AS (SELECT CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE) AS fecha, count(*) AS n FROM inv_outflow GROUP BY 1)
SELECT CAST(d.fecha AS VARCHAR) AS fecha, coalesce(n, 0) AS movimientos FROM days d LEFT JOIN moved USING (fecha)""")
def _calendar(t: Inputs) -> DataFrame:
    moved = t["inv_outflow"].groupBy(text_to_date(F.col("fecha")).alias("fecha")).agg(F.count("*").alias("n"))
    days = S.calendar(t.spark, "1995-01-01", AS_OF)
    return days.join(moved, "fecha", "left").select(
        "fecha", F.coalesce("n", F.lit(0).cast("bigint")).alias("movimientos"))


@query("unknown_members", f"""{MOVEMENT_INPUTS}, codes AS (
SELECT p.id_producto, p.sk_marca FROM inv_outflow o LEFT JOIN inv_product p ON p.codigo_producto = o.serie)
SELECT coalesce('Brand#' || sk_marca, 'SIN_MARCA') AS nk_marca, coalesce(sk_marca, -1) AS sk_marca,
       CAST(count(CASE WHEN id_producto IS NULL THEN 1 END) AS BIGINT) AS sin_producto, count(*) AS movimientos
FROM codes GROUP BY sk_marca""")
def _unknown(t: Inputs) -> DataFrame:
    unknown = S.unknown_members(t.spark)
    brands = t["inv_brand"].where(F.col("sk_marca") != V.UNKNOWN_KEY).select("sk_marca", F.col("nombre_marca").alias("nk_marca")).unionByName(
        unknown["dim_marca"].select("sk_marca", "nk_marca"))
    product_key = unknown["dim_producto"].select("sk_producto").scalar()
    # Repeats of a code are counted first, then looked up once.
    per_code = t["inv_outflow"].groupBy("serie").agg(F.count("*").alias("n"))
    keyed = lookup_or_null(per_code, "serie", t["inv_product"], "codigo_producto",
                           {"id_producto": "sk_producto", "sk_marca": "sk_marca"}).withColumns({
        "sk_producto": F.coalesce("sk_producto", product_key),
        "sk_marca": F.coalesce("sk_marca", F.lit(V.UNKNOWN_KEY))})
    counted = keyed.groupBy("sk_marca").agg(
        F.sum(F.when(F.col("sk_producto") == product_key, F.col("n")).otherwise(0)).alias("sin_producto"),
        F.sum("n").alias("movimientos"))
    return counted.join(brands, "sk_marca").select("nk_marca", "sk_marca", "sin_producto", "movimientos")


@query("unknown_product", f"""{MOVEMENT_INPUTS}
SELECT -1 AS sk_producto, 'SIN_PRODUCTO' AS nk_codigo_producto, 'Producto Sin Definir' AS nombre_producto, 'SIN_MARCA' AS nk_marca,
       'ND' AS nk_categoria, '1900-01-01' AS fecha_inicio_vigencia, '9999-12-31' AS fecha_fin_vigencia, TRUE AS es_registro_activo,
       TRUE AS es_sin_definir, count(*) AS movimientos
FROM inv_outflow o WHERE NOT EXISTS (SELECT 1 FROM inv_product p WHERE p.codigo_producto = o.serie)""")
def _unknown_product(t: Inputs) -> DataFrame:
    """The unknown product with its brand and category, and the movements that point to it."""
    unknown = S.unknown_members(t.spark)
    row = unknown["dim_producto"].join(unknown["dim_marca"].select("sk_marca", "nk_marca"), "sk_marca").join(
        unknown["dim_categoria"].select("sk_categoria", "nk_categoria"), "sk_categoria").drop("sk_marca", "sk_categoria")
    lost = t["inv_outflow"].join(t["inv_product"].select(F.col("codigo_producto").alias("serie")), "serie", "left_anti")
    return row.crossJoin(lost.agg(F.count("*").alias("movimientos")))
