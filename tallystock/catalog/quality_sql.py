"""DuckDB side of the sheet queries: row kinds, landing flags and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import AS_OF, Inputs, with_inputs
from tallystock.operators.filters import row_kind
from tallystock.sources.files import load_log

SHEET_INPUTS = with_inputs("inv_sheet", "inv_lots", "inv_catalogue", "inv_kardex")


def cell(c: str) -> str:
    return f"nullif(trim({c}), '')"


def code(c: str) -> str:
    return f"nullif(trim(ltrim({c}, '''')), '')"


def name(c: str) -> str:
    return f"nullif(regexp_replace(trim({c}), ' +', ' ', 'g'), '')"


def numeric(c: str) -> str:
    digits = r"[0-9]+(_[0-9]+)*"
    pattern = rf"[+-]?({digits}\.?({digits})?|\.{digits})([eE][+-]?{digits})?"
    return f"coalesce(regexp_full_match(trim(replace({c}, ',', '')), '{pattern}'), false)"


def date_ok(c: str) -> str:
    tries = ", ".join(f"try_strptime(substr({c}, 1, 10), '{f}')" for f in ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y"])
    return f"({c} IS NULL OR upper({c}) IN ('N/A', 'NA', 'NONE') OR coalesce({tries}) IS NOT NULL)"


_SECTIONS = """CASE lower(trim(codigo_raw)) WHEN 'granular - solubles' THEN 'Granular - Solubles'
  WHEN 'granular-solubles' THEN 'Granular - Solubles' WHEN 'liquidos' THEN 'Liquidos' WHEN 'líquidos' THEN 'Liquidos'
  WHEN 'material para invernaderos - sustrato y otros' THEN 'Material para Invernaderos - Sustrato y Otros'
  WHEN 'material para invernaderos' THEN 'Material para Invernaderos - Sustrato y Otros' END"""
_IS_HEADER = f"coalesce(lower({code('codigo_raw')}) IN ('codigo', 'código', 'cod', 'code', 'tipo'), false)"
_NO_CELLS = "coalesce(codigo_raw, nombre_raw, fisico_raw, sistema_raw) IS NULL"
_COUNT_FLAGS = f"""{code('codigo_raw')} IS NOT NULL AS lnd_tiene_codigo, {name('nombre_raw')} IS NOT NULL AS lnd_tiene_nombre,
  {numeric('fisico_raw')} AS lnd_fisico_numerico, {numeric('sistema_raw')} AS lnd_sistema_numerico"""
_COUNT_READY = "lnd_tiene_codigo AND lnd_tiene_nombre AND lnd_fisico_numerico AS lnd_listo_para_stg"

MAIN = f"""main_cells AS (SELECT id_archivo, id_carga, fila_excel, {cell('c1')} AS codigo_raw, {cell('c2')} AS nombre_raw,
  {cell('c3')} AS fisico_raw, {cell('c4')} AS sistema_raw, {cell('c5')} AS diferencia_raw, {cell('c6')} AS observacion_raw
  FROM inv_sheet WHERE fila_excel >= 4),
main_kind AS (SELECT *, {_SECTIONS} AS seccion, CASE WHEN {_NO_CELLS} THEN 'vacia' WHEN {_IS_HEADER} THEN 'encabezado'
  WHEN {_SECTIONS} IS NOT NULL THEN 'seccion' ELSE 'dato' END AS tipo_fila FROM main_cells),
main_filled AS (SELECT *, last_value(seccion IGNORE NULLS) OVER (PARTITION BY id_carga ORDER BY fila_excel
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS categoria_raw, {_COUNT_FLAGS} FROM main_kind),
main_landed AS (SELECT *, {_COUNT_READY} FROM main_filled WHERE tipo_fila = 'dato')"""

LOTS = f"""lots_cells AS (SELECT id_archivo, id_carga, fila_excel, {cell('c0')} AS lote_raw, {cell('c1')} AS codigo_raw,
  {cell('c2')} AS nombre_raw, {cell('c3')} AS estado, {cell('c4')} AS fisico_raw, {cell('c5')} AS sistema_raw,
  {cell('c6')} AS diferencia_raw, {cell('c7')} AS observacion_raw, {cell('c8')} AS venc, {cell('c11')} AS almacenaje_raw
  FROM inv_lots WHERE fila_excel >= 4),
lots_kind AS (SELECT *, CASE WHEN {_NO_CELLS} THEN 'vacia' WHEN {_IS_HEADER} THEN 'encabezado' ELSE 'dato' END AS tipo_fila,
  CASE WHEN estado IN ('N/A', 'NA') THEN NULL WHEN {numeric('estado')}
       THEN CAST(CAST(trunc(CAST(replace(replace(estado, ',', ''), '_', '') AS DOUBLE)) AS BIGINT) AS VARCHAR)
       ELSE estado END AS estado_lote_raw,
  CASE WHEN venc NOT IN ('N/A', 'NA') THEN venc END AS fecha_venc_raw FROM lots_cells),
lots_flagged AS (SELECT *, {_COUNT_FLAGS}, {date_ok('fecha_venc_raw')} AS lnd_fecha_venc_parseable,
  {numeric('almacenaje_raw')} AS lnd_almacenaje_numerico FROM lots_kind WHERE tipo_fila = 'dato'),
lots_landed AS (SELECT *, {_COUNT_READY} FROM lots_flagged)"""

CATALOGUE = f"""cat_cells AS (SELECT id_archivo, id_carga, fila_excel, {cell('c0')} AS codigo_raw, {cell('c1')} AS descripcion_raw,
  {cell('c2')} AS precio1_raw, {cell('c3')} AS precio2_raw, {cell('c4')} AS precio3_raw, {cell('c5')} AS existencia_raw
  FROM inv_catalogue WHERE fila_excel >= 2),
cat_kind AS (SELECT *, CASE WHEN coalesce(codigo_raw, descripcion_raw) IS NULL THEN 'vacia' WHEN {_IS_HEADER}
  THEN 'encabezado' ELSE 'dato' END AS tipo_fila FROM cat_cells),
cat_flagged AS (SELECT *, {code('codigo_raw')} IS NOT NULL AS lnd_tiene_codigo,
  {name('descripcion_raw')} IS NOT NULL AS lnd_tiene_descripcion, {numeric('precio1_raw')} AS lnd_precio1_numerico,
  {numeric('existencia_raw')} AS lnd_existencia_numerica FROM cat_kind WHERE tipo_fila = 'dato'),
cat_landed AS (SELECT *, lnd_tiene_codigo AND lnd_tiene_descripcion AS lnd_listo_para_stg FROM cat_flagged)"""

KARDEX = f"""kar_cells AS (SELECT id_archivo, id_carga, fila_excel, {cell('c0')} AS tipo_raw, {cell('c1')} AS fecha_raw,
  {cell('c2')} AS doc, {cell('c5')} AS entradas_raw, {cell('c7')} AS salidas_raw FROM inv_kardex WHERE fila_excel >= 2),
kar_kind AS (SELECT *, CASE WHEN coalesce(tipo_raw, fecha_raw) IS NULL THEN 'vacia'
  WHEN coalesce(lower(tipo_raw) = 'tipo', false) THEN 'encabezado' ELSE 'dato' END AS tipo_fila FROM kar_cells),
kar_flagged AS (SELECT *, {code('doc')} AS documento_raw, tipo_raw IS NOT NULL AS lnd_tiene_tipo,
  {date_ok('fecha_raw')} AS lnd_fecha_parseable, {numeric('entradas_raw')} AS lnd_entradas_numericas,
  {numeric('salidas_raw')} AS lnd_salidas_numericas,
  coalesce(tipo_raw IN ('Entrada Inventario-SI', 'Salida Inventario-SI', 'Toma Física', 'Venta-CONSUMIDOR FINAL-SI',
    'Venta-NOTA DE CRÉDITO FISOFT-SI', 'Entrada'), false) AS lnd_tipo_reconocido FROM kar_kind WHERE tipo_fila = 'dato'),
kar_landed AS (SELECT *, lnd_tiene_tipo AND lnd_fecha_parseable AND lnd_tipo_reconocido AS lnd_listo_para_stg
  FROM kar_flagged)"""

# One load per sheet, of all four kinds; needs MAIN, LOTS, CATALOGUE and KARDEX.
LOADS = f"""loads AS (SELECT id_archivo, id_carga, hoja_procesada, count(*) AS filas_leidas,
  count(*) FILTER (tipo_fila = 'vacia') AS filas_vacias, count(*) FILTER (tipo_fila = 'seccion') AS filas_seccion,
  count(*) FILTER (tipo_fila = 'dato') AS filas_insertadas, 'Completado' AS estado,
  strftime(DATE '{AS_OF}', '%Y-%m') AS periodo_datos
  FROM (SELECT id_archivo, id_carga, 'principal' AS hoja_procesada, tipo_fila FROM main_kind
        UNION ALL SELECT id_archivo, id_carga, 'lotes', tipo_fila FROM lots_kind
        UNION ALL SELECT id_archivo, id_carga, 'catalogo', tipo_fila FROM cat_kind
        UNION ALL SELECT id_archivo, id_carga, 'movimientos', tipo_fila FROM kar_kind) k
  GROUP BY id_archivo, id_carga, hoja_procesada)"""


def kinds(t: Inputs, kind: str) -> DataFrame:
    """Row kinds of one kind of sheet."""
    return t.sheet(kind).select("id_archivo", "id_carga", F.lit(kind).alias("hoja_procesada"),
                                row_kind(kind).alias("tipo_fila"))


def loads(t: Inputs) -> DataFrame:
    rows = kinds(t, "principal")
    for kind in ("lotes", "catalogo", "movimientos"):
        rows = rows.unionByName(kinds(t, kind))
    return load_log(rows, ["id_archivo", "id_carga", "hoja_procesada"], F.lit(AS_OF).cast("date"))
