"""Landing flags, warnings, rule codes, counters and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import Inputs, with_inputs
from tallystock.catalog.quality_sql import CATALOGUE, KARDEX, LOADS, LOTS, MAIN, SHEET_INPUTS, loads
from tallystock.catalog.registry import pct, query
from tallystock.catalog.reports import MOVEMENT_INPUTS, MOVEMENTS, movements
from tallystock.catalog.star_sql import fact, star_sql
from tallystock.operators.aggregates import coverage_gate
from tallystock.operators.lookups import counts_per_key
from tallystock.operators.windows import fill_down
from tallystock.operators.filters import row_kind
from tallystock.functions import cells
from tallystock.plans.constraints import Check, check_tables, constraint_checks, declared_checks, quarantine
from tallystock.plans.quality import clean_counts, land, row_counters, warnings

_KEYS = ["id_carga", "fila_excel"]


def _flags(landed: DataFrame, *extra: str) -> DataFrame:
    return landed.select(*_KEYS, *extra, *[c for c in landed.columns if c.startswith("lnd_")])


@query("flags_main", f"""{SHEET_INPUTS}, {MAIN}
SELECT id_carga, fila_excel, categoria_raw, lnd_tiene_codigo, lnd_tiene_nombre, lnd_fisico_numerico,
       lnd_sistema_numerico, lnd_listo_para_stg FROM main_landed""")
def _main(t: Inputs) -> DataFrame:
    return _flags(land(t.sheet("principal"), "principal"), "categoria_raw")


@query("flags_lots", f"""{SHEET_INPUTS}, {LOTS}
SELECT id_carga, fila_excel, estado_lote_raw, fecha_venc_raw, lnd_tiene_codigo, lnd_tiene_nombre, lnd_fisico_numerico,
       lnd_sistema_numerico, lnd_fecha_venc_parseable, lnd_almacenaje_numerico, lnd_listo_para_stg FROM lots_landed""")
def _lots(t: Inputs) -> DataFrame:
    return _flags(land(t.sheet("lotes"), "lotes"), "estado_lote_raw", "fecha_venc_raw")


@query("flags_catalogue", f"""{SHEET_INPUTS}, {CATALOGUE}
SELECT id_carga, fila_excel, lnd_tiene_codigo, lnd_tiene_descripcion, lnd_precio1_numerico, lnd_existencia_numerica,
       lnd_listo_para_stg FROM cat_landed""")
def _catalogue(t: Inputs) -> DataFrame:
    return _flags(land(t.sheet("catalogo"), "catalogo"))


@query("flags_movements", f"""{SHEET_INPUTS}, {KARDEX}
SELECT id_carga, fila_excel, documento_raw, lnd_tiene_tipo, lnd_fecha_parseable, lnd_entradas_numericas,
       lnd_salidas_numericas, lnd_tipo_reconocido, lnd_listo_para_stg FROM kar_landed""")
def _movements(t: Inputs) -> DataFrame:
    return _flags(land(t.sheet("movimientos"), "movimientos"), "documento_raw")


_W = "id_carga, fila_excel, '{0}' AS regla_violada, '{1}' AS campo_erroneo, {1} AS valor_recibido, 'WARNING' AS severidad"


@query("warnings", f"""{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX}
SELECT {_W.format('RV-04', 'sistema_raw')} FROM main_landed WHERE NOT lnd_sistema_numerico AND fisico_raw IS NOT NULL
UNION ALL SELECT {_W.format('RV-02', 'nombre_raw')} FROM main_landed WHERE lnd_tiene_codigo AND NOT lnd_tiene_nombre
UNION ALL SELECT {_W.format('RV-01', 'codigo_raw')} FROM main_landed WHERE lnd_tiene_nombre AND NOT lnd_tiene_codigo
UNION ALL SELECT {_W.format('RV-04', 'sistema_raw')} FROM lots_landed WHERE NOT lnd_sistema_numerico AND fisico_raw IS NOT NULL
UNION ALL SELECT {_W.format('FECHA_VENC', 'fecha_venc_raw')} FROM lots_landed WHERE NOT lnd_fecha_venc_parseable
UNION ALL SELECT {_W.format('RV-02', 'nombre_raw')} FROM lots_landed WHERE lnd_tiene_codigo AND NOT lnd_tiene_nombre
UNION ALL SELECT {_W.format('RV-01', 'codigo_raw')} FROM lots_landed WHERE lnd_tiene_nombre AND NOT lnd_tiene_codigo
UNION ALL SELECT {_W.format('PRECIO_CERO', 'precio1_raw')} FROM cat_landed WHERE precio1_raw IS NULL OR precio1_raw = '0'
UNION ALL SELECT {_W.format('RV-14', 'tipo_raw')} FROM kar_landed WHERE lnd_tiene_tipo AND NOT lnd_tipo_reconocido
UNION ALL SELECT {_W.format('FECHA', 'fecha_raw')} FROM kar_landed WHERE NOT lnd_fecha_parseable""")
def _warnings(t: Inputs) -> DataFrame:
    logs = [warnings(land(t.sheet(k), k), k, _KEYS) for k in ["principal", "lotes", "catalogo", "movimientos"]]
    return logs[0].unionByName(logs[1]).unionByName(logs[2]).unionByName(logs[3])


# Rows as the staging step reads them, with the reasons a row can fail still in.
_STAGE = f"""{SHEET_INPUTS}, {MAIN}, staged AS (SELECT id_carga, fila_excel, ltrim(coalesce(codigo_raw, ''), '''') AS cod,
  trim(nombre_raw) AS nom, TRY_CAST(replace(fisico_raw, ',', '') AS DECIMAL(12,2)) AS f,
  TRY_CAST(replace(sistema_raw, ',', '') AS DECIMAL(12,2)) AS s,
  TRY_CAST(replace(diferencia_raw, ',', '') AS DECIMAL(12,2)) AS d, fisico_raw, sistema_raw, diferencia_raw FROM main_landed)"""


@query("rule_code", f"""{_STAGE}
SELECT id_carga, fila_excel, fisico_raw, sistema_raw, diferencia_raw, CAST(coalesce(f, 0) AS DOUBLE) AS fisico,
       CAST(coalesce(s, 0) AS DOUBLE) AS sistema, CAST(d AS DOUBLE) AS diferencia,
       CASE WHEN cod = '' THEN 'ERROR RV-01' WHEN f < 0 THEN 'ERROR RV-03:' WHEN nom IS NULL THEN 'WARNING RV-02'
            WHEN s IS NULL THEN 'WARNING RV-04' WHEN abs((f - s) - d) > 0.01 THEN 'WARNING RV-05' ELSE 'OK' END
         AS error_column FROM staged""")
def _rule_code(t: Inputs) -> DataFrame:
    landed = land(t.sheet("principal"), "principal")
    named = landed.withColumns({"codigo_limpio": cells.clean_code_view(F.col("codigo_raw")),
                                "nombre_limpio": F.trim("nombre_raw")})
    return clean_counts(named).select(*_KEYS, "fisico_raw", "sistema_raw", "diferencia_raw", "fisico", "sistema",
                                      "diferencia", "error_column")


@query("fill_down", f"{SHEET_INPUTS}, {MAIN} SELECT id_carga, fila_excel, tipo_fila, categoria_raw FROM main_filled")
def _fill(t: Inputs) -> DataFrame:
    rows = t.sheet("principal").withColumn("tipo_fila", row_kind("principal"))
    titled = rows.withColumn("_t", F.when(F.col("tipo_fila") == "seccion", cells.section_name(F.col("codigo_raw"))))
    return fill_down(titled, "_t", ["id_carga"], "fila_excel", "categoria_raw").select(
        *_KEYS, "tipo_fila", "categoria_raw")


@query("coverage_gate", f"""{SHEET_INPUTS}, {MAIN}
SELECT id_carga, count(*) AS total, count(codigo_raw) AS con_codigo,
       {pct("count(codigo_raw)", "count(*)")} AS pct_codigo,
       CASE WHEN count(codigo_raw) * 100 < count(*) * 80 THEN 'WARNING' ELSE 'OK' END AS estado
FROM main_kind WHERE tipo_fila = 'dato' GROUP BY id_carga""")
def _coverage(t: Inputs) -> DataFrame:
    return coverage_gate(t.sheet("principal"), "id_carga")


_COUNTS = """count(*) AS leidas, count(*) FILTER (tipo_fila = 'vacia') AS vacias,
  count(*) FILTER (tipo_fila = 'seccion') AS secciones, count(*) FILTER (tipo_fila = 'encabezado') AS encabezados,
  count(*) FILTER (tipo_fila = 'dato') AS insertadas"""
_COUNT_WARNINGS = """CAST(sum(CASE WHEN NOT lnd_sistema_numerico AND fisico_raw IS NOT NULL THEN 1 ELSE 0 END
  + CASE WHEN lnd_tiene_codigo <> lnd_tiene_nombre THEN 1 ELSE 0 END{0}) AS BIGINT) AS warnings"""


def _counters_sql(kind: str, kinds_: str, landed: str, raised: str) -> str:
    return f"""SELECT '{kind}' AS hoja_procesada, k.*, coalesce(w.warnings, 0) AS warnings FROM (
  SELECT id_carga, {_COUNTS} FROM {kinds_} GROUP BY id_carga) k LEFT JOIN (
  SELECT id_carga, {raised} FROM {landed} GROUP BY id_carga) w ON w.id_carga = k.id_carga"""


@query("row_counters", f"{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX} " + " UNION ALL ".join([
    _counters_sql("principal", "main_kind", "main_landed", _COUNT_WARNINGS.format("")),
    _counters_sql("lotes", "lots_kind", "lots_landed", _COUNT_WARNINGS.format(
        " + CASE WHEN NOT lnd_fecha_venc_parseable THEN 1 ELSE 0 END")),
    _counters_sql("catalogo", "cat_kind", "cat_landed",
                  "CAST(sum(CASE WHEN precio1_raw IS NULL OR precio1_raw = '0' THEN 1 ELSE 0 END) AS BIGINT) AS warnings"),
    _counters_sql("movimientos", "kar_kind", "kar_landed", """CAST(sum(CASE WHEN lnd_tiene_tipo AND NOT lnd_tipo_reconocido
      THEN 1 ELSE 0 END + CASE WHEN NOT lnd_fecha_parseable THEN 1 ELSE 0 END) AS BIGINT) AS warnings"""),
]))
def _counters(t: Inputs) -> DataFrame:
    parts = [row_counters(t.sheet(k), k, ["id_carga"]).select(F.lit(k).alias("hoja_procesada"), "*")
             for k in ["principal", "lotes", "catalogo", "movimientos"]]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("correlated_counts", f"""{SHEET_INPUTS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX}, {LOADS}
SELECT l.id_carga, (SELECT count(*) FROM lots_landed m WHERE m.id_carga = l.id_carga AND NOT lnd_fecha_venc_parseable) AS sin_fecha,
       (SELECT count(*) FROM lots_landed m WHERE m.id_carga = l.id_carga AND lnd_almacenaje_numerico) AS con_almacenaje
FROM loads l""")
def _correlated(t: Inputs) -> DataFrame:
    return counts_per_key(
        land(t.sheet("lotes"), "lotes"), "id_carga",
        {"sin_fecha": ~F.col("lnd_fecha_venc_parseable"), "con_almacenaje": F.col("lnd_almacenaje_numerico")},
        loads(t).select("id_carga"))


@query("constraint_checks", f"""{star_sql('inv_dim_product')}
SELECT 'pk' AS regla, CAST(coalesce((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM fi GROUP BY sk_tiempo, sk_producto) x), 0) AS BIGINT) AS incumplimientos
UNION ALL SELECT 'uq_marca_anio', CAST(coalesce((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM fi GROUP BY sk_tiempo, sk_marca) x), 0) AS BIGINT)
UNION ALL SELECT 'fk_producto', count(*) FROM fi WHERE sk_producto NOT IN (SELECT sk_producto FROM inv_dim_product WHERE es_registro_activo)
UNION ALL SELECT 'fisica_no_negativa', count(*) FROM fi WHERE NOT cantidad_fisica >= 0
UNION ALL SELECT 'sistema_mayor_cero', count(*) FROM fi WHERE NOT cantidad_sistema > 0
UNION ALL SELECT 'anio_en_rango', count(*) FROM fi WHERE NOT (sk_tiempo = -1 OR sk_tiempo BETWEEN 19960101 AND 20001231)
UNION ALL SELECT 'semaforo_no_nulo', count(*) FROM fi
UNION ALL SELECT 'largo_estado', 0""")
def _constraints(t: Inputs) -> DataFrame:
    active = t["inv_dim_product"].where("es_registro_activo")
    key = F.col("sk_tiempo")
    return constraint_checks(fact(t), [
        Check("pk", "unique", ("sk_tiempo", "sk_producto")),
        Check("uq_marca_anio", "unique", ("sk_tiempo", "sk_marca")),
        Check("fk_producto", "reference", ("sk_producto",), parent=active, parent_key="sk_producto"),
        Check("fisica_no_negativa", "rule", condition=F.col("cantidad_fisica") >= 0),
        Check("sistema_mayor_cero", "rule", condition=F.col("cantidad_sistema") > 0),
        # The unknown-date row is exempt from range checks.
        Check("anio_en_rango", "rule", condition=(key == -1) | key.between(19960101, 20001231)),
        Check("semaforo_no_nulo", "rule", condition=F.col("sk_tipo_semaforo").isNotNull()),
        Check("largo_estado", "rule", condition=F.length(F.col("sk_estado_stock").cast("string")) <= 30),
    ])


@query("declared_constraints", f"""{MOVEMENT_INPUTS}, {MOVEMENTS}
SELECT 'cantidad > 0' AS regla, count(*) AS incumplimientos FROM moves WHERE NOT cantidad > 0
UNION ALL SELECT 'cantidad no nulo', count(*) FROM moves WHERE cantidad IS NULL
UNION ALL SELECT 'id_producto no nulo', count(*) FROM moves WHERE id_producto IS NULL
UNION ALL SELECT 'id_tipo_mov no nulo', count(*) FROM moves WHERE id_tipo_mov IS NULL
UNION ALL SELECT 'fecha_movimiento no nulo', count(*) FROM moves WHERE fecha_movimiento IS NULL
UNION ALL SELECT 'id_bodega no nulo', count(*) FROM moves UNION ALL SELECT 'usuario_registro no nulo', count(*) FROM moves
UNION ALL SELECT 'largo de numero_documento', 0 UNION ALL SELECT 'largo de observacion', 0
UNION ALL SELECT 'id_producto existe', count(*) FROM moves WHERE id_producto NOT IN (SELECT id_producto FROM inv_product WHERE p_size > 3)""")
def _declared(t: Inputs) -> DataFrame:
    """The movements lack two columns that the model asks for; each of their rows breaks these."""
    stocked = t["inv_product"].where("p_size > 3")
    return constraint_checks(movements(t), declared_checks("movimiento_inventario", {"id_producto": stocked}))


def _operational(t: Inputs) -> dict[str, DataFrame]:
    products = t["inv_product"].where("p_size > 3").select(
        "id_producto", "codigo_producto", "nombre", F.col("sk_categoria").alias("id_categoria"), F.col("sk_marca").alias("id_marca"))
    return {"toma_fisica": t["inv_count"], "bodega": t["inv_store"], "producto": products, "detalle_toma_fisica": t["inv_count_line"]}


_OPERATIONAL = f"""{with_inputs('inv_count', 'inv_count_line', 'inv_store')}, toma_fisica AS (SELECT * FROM inv_count),
detalle_toma_fisica AS (SELECT * FROM inv_count_line), bodega AS (SELECT * FROM inv_store), producto AS (
  SELECT id_producto, codigo_producto, nombre, sk_categoria AS id_categoria, sk_marca AS id_marca FROM inv_product WHERE p_size > 3)"""


def _rule_sql(table: str, name: str, broken: str) -> str:
    return f"SELECT '{table}' AS tabla, '{name}' AS regla, count(*) AS incumplimientos FROM {table} WHERE {broken}"


def _unique_sql(table: str, columns: str) -> str:
    held = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
    return (f"SELECT '{table}', '{columns} unico', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} "
            f"WHERE {held} GROUP BY {columns}) x")


def _absent_sql(table: str, name: str) -> str:
    return f"SELECT '{table}', '{name}', 0"


_LINE = "detalle_toma_fisica"
_MISSING = "{0} IS NOT NULL AND {0} NOT IN (SELECT {0} FROM {1} WHERE {0} IS NOT NULL)"
_REPORT = " UNION ALL ".join([
    _rule_sql("toma_fisica", "estado en lista", "estado NOT IN ('Planificada', 'En Proceso', 'Completada', 'Cancelada')"),
    *(_unique_sql("toma_fisica", c) for c in ("id_toma", "codigo_toma")),
    *(_rule_sql("toma_fisica", f"{c} no nulo", f"{c} IS NULL") for c in ("codigo_toma", "fecha_inicio", "responsable", "estado")),
    *(_rule_sql("toma_fisica", f"largo de {c}", f"length({c}) > {n}") for c, n in (("codigo_toma", 20), ("responsable", 120))),
    _absent_sql("toma_fisica", "largo de aprobado_por"),
    *(_unique_sql("bodega", c) for c in ("id_bodega", "codigo_bodega")),
    *(_rule_sql("bodega", f"{c} no nulo", f"{c} IS NULL") for c in ("codigo_bodega", "nombre", "tipo_almacenaje")),
    *(_rule_sql("bodega", f"largo de {c}", f"length({c}) > {n}") for c, n in (("codigo_bodega", 10), ("nombre", 80))),
    _rule_sql("bodega", "tipo_almacenaje en lista", "tipo_almacenaje NOT IN ('General', 'Área Especial', 'En Tránsito', 'Cuarentena')"),
    _unique_sql("producto", "codigo_producto"), _rule_sql("producto", "largo de codigo_producto", "length(codigo_producto) > 30"),
    *(_rule_sql("producto", f"{c} no nulo", f"{c} IS NULL") for c in ("codigo_producto", "nombre", "id_categoria", "id_marca")),
    _rule_sql("producto", "id_unidad no nulo", "true"),
    _absent_sql(_LINE, "id_detalle unico"), _unique_sql(_LINE, "id_toma, id_producto, id_bodega"),
    *(_rule_sql(_LINE, f"{c} >= 0", f"{c} < 0") for c in ("cantidad_fisica", "cantidad_sistema")),
    *(_rule_sql(_LINE, f"{c} no nulo", f"{c} IS NULL") for c in ("id_toma", "id_producto", "id_bodega", "cantidad_fisica", "cantidad_sistema")),
    _rule_sql(_LINE, "largo de observacion", "length(observacion) > 500"), _absent_sql(_LINE, "largo de contado_por"),
    *(_rule_sql(_LINE, f"{c} existe", _MISSING.format(c, parent)) for c, parent in (
        ("id_toma", "toma_fisica"), ("id_producto", "producto"), ("id_bodega", "bodega"))),
])


@query("operational_constraints", f"{_OPERATIONAL} {_REPORT}")
def _operational_report(t: Inputs) -> DataFrame:
    return check_tables(_operational(t))


@query("quarantine", f"""{_OPERATIONAL}, repeated AS (
  SELECT id_toma, id_producto, id_bodega, count(*) AS n FROM {_LINE} WHERE id_bodega IS NOT NULL GROUP BY ALL HAVING n > 1),
judged AS (SELECT d.*, array_to_string(list_sort(list_filter([
    CASE WHEN r.n IS NOT NULL THEN 'id_toma, id_producto, id_bodega unico' END, CASE WHEN cantidad_fisica < 0 THEN 'cantidad_fisica >= 0' END,
    CASE WHEN cantidad_sistema < 0 THEN 'cantidad_sistema >= 0' END, CASE WHEN d.id_bodega IS NULL THEN 'id_bodega no nulo' END,
    CASE WHEN cantidad_sistema IS NULL THEN 'cantidad_sistema no nulo' END,
    CASE WHEN {_MISSING.format('d.id_toma', 'toma_fisica').replace('SELECT d.', 'SELECT ').replace('WHERE d.', 'WHERE ')} THEN 'id_toma existe' END,
    CASE WHEN {_MISSING.format('d.id_producto', 'producto').replace('SELECT d.', 'SELECT ').replace('WHERE d.', 'WHERE ')} THEN 'id_producto existe' END,
    CASE WHEN {_MISSING.format('d.id_bodega', 'bodega').replace('SELECT d.', 'SELECT ').replace('WHERE d.', 'WHERE ')} THEN 'id_bodega existe' END
  ], lambda x: x IS NOT NULL)), '; ') AS reglas FROM {_LINE} d LEFT JOIN repeated r USING (id_toma, id_producto, id_bodega))
SELECT id_toma, id_producto, id_bodega, CAST(cantidad_fisica AS DOUBLE) AS cantidad_fisica, CAST(cantidad_sistema AS DOUBLE) AS cantidad_sistema,
       observacion, reglas FROM judged WHERE reglas <> ''""")
def _quarantine(t: Inputs) -> DataFrame:
    tables = _operational(t)
    parents = {"id_toma": tables["toma_fisica"], "id_producto": tables["producto"], "id_bodega": tables["bodega"]}
    rows = quarantine(tables["detalle_toma_fisica"], declared_checks("detalle_toma_fisica", parents))
    return rows.withColumn("reglas", F.array_join(F.array_sort("reglas"), "; "))
