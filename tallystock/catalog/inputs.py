"""The test tables seen as inventory data.

Each input is one SELECT that runs unchanged in Spark SQL and in DuckDB, so that a query
and its check start from the same rows. Keys, row numbers and ids are row-local
arithmetic: building an input needs no global sort or numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.sources.seeds import date_dimension, discrepancy_types, unknown_date
from tallystock.sources.sheets import SHEET_WIDTH, positional

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
AS_OF = "2001-12-31"
LIGHT_DATE = "2001-09-01"
COUNT_YEAR = 1998
COUNT_KEY = COUNT_YEAR * 10000 + 1231
SHEET_ROWS = 500

_CATEGORY_KEY = ("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
                 "WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END")
_PRODUCT_CODE = ("CASE WHEN l_partkey % 10 = 9 THEN concat('X', CAST(l_partkey AS STRING)) "
                 "WHEN l_partkey % 17 = 0 THEN concat('ABP', CAST(l_partkey AS STRING)) "
                 "ELSE CAST(l_partkey AS STRING) END")



def _line(sheet: str, columns: dict[int, str], width: int) -> str:
    """SQL of a sheet's line: name, row number and cells, in quotes where that is needed."""
    def quoted(c: str) -> str:
        return f"CASE WHEN {c} LIKE '%,%' OR {c} LIKE '%\"%' THEN concat('\"', replace({c}, '\"', '\"\"'), '\"') ELSE coalesce({c}, '') END"
    cells = [quoted(columns[k]) if k in columns else "''" for k in range(width)]
    return f"concat({quoted(sheet)}, ',', CAST(fila_excel AS STRING), ',', {", ',', ".join(cells)})"


LOT_SHEET = ("CASE CAST(id_archivo % 3 AS INT) WHEN 0 THEN 'Manvert, Jiffy' WHEN 1 THEN 'Manvert,Jiffy' ELSE 'Manvert Jiffy' END")
_KARDEX_NAME = "CASE WHEN id_archivo % 5 = 3 THEN 'Kardex' ELSE 'EJEMPLO DATOS KARDEX' END"

INPUTS = {
    # One row per part: a section, a name that hits the keyword rules, an expiry date.
    "inv_product": (f"""
SELECT p_partkey AS id_producto,
       CASE WHEN p_partkey % 17 = 0 THEN concat('ABP', CAST(p_partkey AS STRING))
            ELSE CAST(p_partkey AS STRING) END AS codigo_producto,
       concat(upper(p_name), CASE CAST(p_partkey % 16 AS INT)
         WHEN 0 THEN ' UREA 50 KG'        WHEN 1 THEN ' SOLU MAP 25KG'    WHEN 2 THEN ' POEMA GATOS'
         WHEN 3 THEN ' TURBA SC18L'       WHEN 4 THEN ' JIFFY CJ2816'     WHEN 5 THEN ' MANVERT 5 LT'
         WHEN 6 THEN ' BRANDT 2.5 GAL'    WHEN 7 THEN ' FERTI K 250 GRAMOS' WHEN 8 THEN ' SARAN 4,5M ROLLO'
         WHEN 9 THEN ' YARAMILA 50 KGS'   WHEN 10 THEN ' GRANUPOTASE'     WHEN 11 THEN ' NUTRIMON 1 LB'
         WHEN 12 THEN ' OPISTRA 20L'      WHEN 13 THEN ' BANDEJA'         WHEN 14 THEN ' MF 10-20'
         ELSE '' END) AS nombre,
       CASE WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'Granular - Solubles'
            WHEN p_type IN ('LARGE', 'PROMO') THEN 'Material para Invernaderos - Sustrato y Otros'
            ELSE 'Liquidos' END AS categoria_raw,
       p_brand AS marca, p_size,
       CASE WHEN p_size % 5 = 0 THEN NULL
            ELSE CAST(DATE '{AS_OF}' + CAST(p_size * 10 - 60 AS INT) AS DATE) END AS fecha_vencimiento,
       CAST(substr(p_brand, 7) AS INT) AS sk_marca, CAST({_CATEGORY_KEY} AS INT) AS sk_categoria
FROM part""", []),
    # Product x yearly count: every stock status but one, both signs, notes and no notes. Every
    # tenth category and twelfth brand is missing.
    "inv_fact": (f"""
SELECT CAST(y * 10000 + 1231 AS INT) AS sk_tiempo, k AS sk_producto,
       CASE WHEN k % 10 <> 3 THEN CAST({_CATEGORY_KEY} AS INT) END AS sk_categoria,
       CASE WHEN k % 12 <> 5 THEN CAST(substr(p_brand, 7) AS INT) END AS sk_marca,
       CASE WHEN k % 10 <> 3 THEN p_type ELSE '{V.UNDEFINED_CATEGORY}' END AS nombre_categoria,
       CASE WHEN k % 12 <> 5 THEN p_brand ELSE 'Sin Marca Definida' END AS nombre_marca,
       CAST(CASE WHEN m = 1 THEN 0 ELSE q END AS DECIMAL(12,2)) AS cantidad_sistema,
       CAST(CASE WHEN m IN (0, 1) THEN 0
                 WHEN m = 2 THEN q + 1 + p_size % 5
                 WHEN m = 3 THEN greatest(q - 1 - p_size % 5, 0)
                 ELSE q END AS DECIMAL(12,2)) AS cantidad_fisica,
       CASE WHEN m = 3 AND p_size % 3 = 0 THEN 'Pendiente Rebajar'
            WHEN m = 2 AND p_size % 3 = 0 THEN 'Entrega pendiente'
            WHEN m IN (2, 3) AND p_size % 3 = 1 THEN 'Nota: revisar' END AS observacion_texto
FROM (SELECT l_partkey AS k, year(l_shipdate) AS y, sum(l_quantity) AS q,
             (l_partkey * 7 + year(l_shipdate)) % 10 AS m
      FROM lineitem GROUP BY l_partkey, year(l_shipdate)) a
JOIN part ON p_partkey = k""", []),
    "inv_category": (f"""
SELECT DISTINCT CAST({_CATEGORY_KEY} AS INT) AS sk_categoria, p_type AS nombre_categoria,
       CASE WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'Granular'
            WHEN p_type IN ('LARGE', 'PROMO') THEN 'Sustrato-Material' ELSE 'Líquido' END AS tipo_producto
FROM part
UNION ALL SELECT {V.UNKNOWN_KEY}, '{V.UNDEFINED_CATEGORY}', 'Desconocido'""", []),
    "inv_brand": (f"""
SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS sk_marca, p_brand AS nombre_marca,
       CASE CAST(substr(p_brand, 7) AS INT) % 3 WHEN 0 THEN 'Nacional' WHEN 1 THEN 'Importado'
            ELSE 'Desconocido' END AS tipo_proveedor
FROM part
UNION ALL SELECT {V.UNKNOWN_KEY}, 'Sin Marca Definida', 'Desconocido'""", []),
    # Active names are unique here, as the report that joins back on the name expects.
    "inv_dim_product": ("""
SELECT id_producto AS sk_producto, codigo_producto AS nk_codigo_producto,
       concat(nombre, ' #', CAST(id_producto AS STRING)) AS nombre_producto, sk_marca, sk_categoria,
       fecha_vencimiento, CASE WHEN p_size % 5 <> 0 THEN p_size * 10 - 60 END AS dias_para_vencer,
       p_size % 11 <> 0 AS es_registro_activo
FROM inv_product
UNION ALL SELECT -1, 'SIN_PRODUCTO', 'Producto Sin Definir', -1, -1, CAST(NULL AS DATE), CAST(NULL AS INT), TRUE""",
                        ["inv_product"]),
    # Main count sheet, 500 products per workbook: titles, headers, empty and data rows.
    # Some workbooks lack the first title; one title is not a known section.
    "inv_sheet": (f"""
SELECT id_archivo, id_archivo * 10 + 1 AS id_carga, CAST(4 + sec * {SHEET_ROWS + 2} + place AS INT) AS fila_excel,
       c1, c2, c3, c4, c5, c6
FROM (
  SELECT DISTINCT CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT) AS id_archivo, {_CATEGORY_KEY} - 1 AS sec,
         CAST(0 AS BIGINT) AS place,
         CASE WHEN p_type IN ('MEDIUM', 'STANDARD') THEN ' granular - solubles '
              WHEN p_type IN ('LARGE', 'PROMO') THEN 'MATERIAL PARA INVERNADEROS'
              WHEN p_type = 'SMALL' THEN 'Semillas' ELSE 'Líquidos' END AS c1,
         CAST(NULL AS STRING) AS c2, CAST(NULL AS STRING) AS c3, CAST(NULL AS STRING) AS c4,
         CAST(NULL AS STRING) AS c5, CAST(NULL AS STRING) AS c6
  FROM part WHERE p_type <> 'ECONOMY' OR floor(p_partkey / {SHEET_ROWS}) % 3 <> 1
  UNION ALL
  SELECT DISTINCT CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT), {_CATEGORY_KEY} - 1, CAST(1 AS BIGINT),
         'Código', 'Nombre', 'Fisico', 'Sistema', 'Dif', 'Obs'
  FROM part
  UNION ALL
  SELECT CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT), {_CATEGORY_KEY} - 1, 2 + p_partkey % {SHEET_ROWS},
         CASE WHEN p_partkey % 50 = 49 OR p_partkey % 23 = 0 THEN NULL
              ELSE concat('''', CAST(p_partkey AS STRING), ' ') END,
         CASE WHEN p_partkey % 50 = 49 THEN '  ' WHEN p_partkey % 29 = 0 THEN NULL
              ELSE concat(' ', p_name, '  x') END,
         CASE WHEN p_partkey % 50 = 49 THEN NULL WHEN p_partkey % 31 = 0 THEN '-'
              WHEN p_partkey % 37 = 0 THEN concat('-', CAST(p_size AS STRING))
              ELSE concat('1,', lpad(CAST(p_size AS STRING), 3, '0')) END,
         CASE WHEN p_partkey % 50 = 49 OR p_partkey % 19 = 0 THEN NULL
              ELSE CAST(1000 + p_size AS STRING) END,
         CASE WHEN p_partkey % 50 = 49 THEN NULL WHEN p_partkey % 13 = 0 THEN '7' ELSE '0' END,
         CASE WHEN p_partkey % 7 = 0 THEN 'Pendiente Rebajar' ELSE '  ' END
  FROM part
) t""", []),
    # Lot sheet; positions 9 and 10 are never read. Rows 2 and 3 lie above the data.
    "inv_lots": (f"""
SELECT CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT) AS id_archivo,
       CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT) * 10 + 2 AS id_carga,
       CAST(2 + p_partkey % {SHEET_ROWS} AS INT) AS fila_excel,
       concat('''L', CAST(p_partkey AS STRING)) AS c0,
       CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 97 = 5 THEN 'Cod'
            ELSE concat('''''', CAST(p_partkey AS STRING)) END AS c1,
       CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE concat(p_name, '   jiffy ') END AS c2,
       CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'N/A' WHEN 1 THEN '569.0' WHEN 2 THEN '905'
            WHEN 3 THEN '1,239' WHEN 4 THEN 'Cuarentena' ELSE NULL END AS c3,
       CASE WHEN p_partkey % 41 = 0 AND p_partkey % 43 = 0 THEN NULL ELSE CAST(p_size AS STRING) END AS c4,
       CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '1_000'
            ELSE concat(CAST(p_size AS STRING), '.5') END AS c5,
       '0' AS c6, '' AS c7,
       CASE CAST(p_partkey % 8 AS INT) WHEN 0 THEN 'N/A' WHEN 1 THEN '2026-08-15' WHEN 2 THEN '15/8/2026'
            WHEN 3 THEN '8/15/2026' WHEN 4 THEN '15-08-2026' WHEN 5 THEN '2026/08/15'
            WHEN 6 THEN '30/02/2026' ELSE NULL END AS c8,
       '#REF!' AS c9, CAST(NULL AS STRING) AS c10,
       CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN '365' WHEN 1 THEN '12 meses' ELSE NULL END AS c11
FROM part""", []),
    "inv_catalogue": (f"""
SELECT CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT) AS id_archivo,
       CAST(floor(p_partkey / {SHEET_ROWS}) AS BIGINT) * 10 + 3 AS id_carga,
       CAST(2 + p_partkey % {SHEET_ROWS} AS INT) AS fila_excel,
       CASE WHEN p_partkey % 83 = 0 THEN ' CÓDIGO' WHEN p_partkey % 31 = 0 THEN ' '
            ELSE CAST(p_partkey AS STRING) END AS c0,
       CASE WHEN p_partkey % 62 = 0 OR p_partkey % 29 = 1 THEN NULL ELSE p_name END AS c1,
       CASE WHEN p_partkey % 11 = 0 THEN '0' WHEN p_partkey % 12 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'USD'
            ELSE concat('1,', CAST(p_size + 100 AS STRING), '.50') END AS c2,
       CAST(p_size AS STRING) AS c3, CAST(NULL AS STRING) AS c4,
       CASE WHEN p_partkey % 3 = 0 THEN '1e2' ELSE '.5' END AS c5
FROM part""", []),
    "inv_kardex": ("""
SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS id_archivo,
       CAST(floor(o_orderkey / 1000) AS BIGINT) * 10 + 4 AS id_carga,
       CAST(2 + o_orderkey % 1000 AS INT) AS fila_excel,
       CASE CAST(o_custkey % 9 AS INT) WHEN 0 THEN 'Entrada Inventario-SI' WHEN 1 THEN 'Salida Inventario-SI'
            WHEN 2 THEN 'Toma Física' WHEN 3 THEN 'Venta-CONSUMIDOR FINAL-SI'
            WHEN 4 THEN 'Venta-NOTA DE CRÉDITO FISOFT-SI' WHEN 5 THEN ' Entrada ' WHEN 6 THEN 'Ajuste'
            WHEN 7 THEN NULL ELSE 'TIPO' END AS c0,
       CASE CAST(o_orderkey % 7 AS INT)
            WHEN 0 THEN concat(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/',
                               CAST(year(o_orderdate) AS STRING))
            WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 2 THEN NULL WHEN 3 THEN 'n/a'
            WHEN 4 THEN '2001/01/05' WHEN 5 THEN '12/31/2001' ELSE '31-12-2001 10:00' END AS c1,
       concat('''', CAST(o_orderkey AS STRING)) AS c2, CAST(NULL AS STRING) AS c3, '1.0d' AS c4,
       CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN concat('1,', lpad(CAST(o_custkey AS STRING), 4, '0'))
            WHEN 1 THEN '(123)' ELSE NULL END AS c5,
       'nan' AS c6, CAST(o_custkey AS STRING) AS c7, o_orderpriority AS c8, '2.5' AS c9
FROM orders""", []),
    # The sheets of a workbook as lines of a text file. Some have a sheet of unknown name, or only such ones; in some, one
    # line of the movement sheet is cut off inside a quoted cell; dates of some lots are written as date-times.
    "inv_book_line": (f"""
SELECT id_archivo, 1 AS orden, fila_excel, {_line("'Fertilisa'", {k: f'c{k}' for k in range(1, 7)}, 7)} AS linea FROM inv_sheet
UNION ALL SELECT id_archivo, 2, fila_excel, {_line(LOT_SHEET, {k: f'c{k}' for k in range(12)} | {8: "replace(c8, '2026-08-15', '2026-08-15T00:00:00')"}, 12)} FROM inv_lots
UNION ALL SELECT id_archivo, 3, fila_excel, {_line("'LISTA DE PRODUCTOS'", {k: f'c{k}' for k in range(6)}, 12)} FROM inv_catalogue
UNION ALL SELECT id_archivo, 4, fila_excel, {_line(_KARDEX_NAME, {k: f'c{k}' for k in range(10)}, 12)} FROM inv_kardex
UNION ALL SELECT DISTINCT id_archivo, 5, 99999, 'EJEMPLO DATOS KARDEX,99999,\"sin cierre' FROM inv_kardex WHERE id_archivo % 6 = 1 AND id_archivo % 5 <> 3
UNION ALL SELECT DISTINCT id_archivo, 6, 1, 'Hoja1,1,nota' FROM inv_sheet WHERE id_archivo % 4 = 2""",
                      ["inv_sheet", "inv_lots", "inv_catalogue", "inv_kardex"]),
    # Inflow lines take their date from a header; codes ending in 9 are not in the master.
    "inv_inflow": (f"""
SELECT l_orderkey AS id_entrada, {_PRODUCT_CODE} AS codigo, CAST(l_quantity AS DECIMAL(12,2)) AS cantidad
FROM lineitem WHERE l_returnflag = 'R'""", []),
    "inv_inflow_header": ("""
SELECT o_orderkey AS codigo,
       concat(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/',
              CAST(year(o_orderdate) AS STRING)) AS fecha
FROM orders""", []),
    # The same with repeats: codes with a second product, headers with a second, later date.
    "inv_repeated_product": ("""
SELECT * FROM inv_product
UNION ALL SELECT id_producto + 10000000, codigo_producto, nombre, categoria_raw, marca, p_size, fecha_vencimiento, sk_marca, sk_categoria
FROM inv_product WHERE p_size % 3 = 0""", ["inv_product"]),
    "inv_repeated_header": ("""
SELECT * FROM inv_inflow_header UNION ALL SELECT codigo, '31/12/2009' FROM inv_inflow_header WHERE codigo % 3 = 0""",
                            ["inv_inflow_header"]),
    "inv_outflow": (f"""
SELECT {_PRODUCT_CODE} AS serie,
       CAST(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,2)) AS cantidad,
       concat(CAST(day(l_shipdate) AS STRING), '/', CAST(month(l_shipdate) AS STRING), '/',
              CAST(year(l_shipdate) AS STRING)) AS fecha
FROM lineitem WHERE l_returnflag <> 'R'""", []),
    # Two states of the product table: renames, new expiry dates, inserts, deletes.
    "inv_product_v1": (f"""
SELECT p_partkey AS id, p_name AS nombre, p_brand AS presentacion,
       CAST(DATE '{AS_OF}' + p_size AS DATE) AS fecha_vencimiento
FROM part WHERE p_partkey % 13 <> 0""", []),
    "inv_product_v2": (f"""
SELECT p_partkey AS id,
       CASE WHEN p_partkey % 7 = 0 THEN concat(p_name, ' v2') ELSE p_name END AS nombre,
       p_brand AS presentacion,
       CASE WHEN p_partkey % 11 = 0 THEN NULL
            ELSE CAST(DATE '{AS_OF}' + p_size AS DATE) END AS fecha_vencimiento
FROM part WHERE p_partkey % 19 <> 0""", []),
    # Counts, their lines and the warehouses, with breaches of most constraints: codes that repeat, states that are none,
    # lines that come twice, quantities below zero or missing, keys that point nowhere.
    "inv_count": (f"""
SELECT DISTINCT sk_tiempo AS id_toma, concat('TF-', CAST(CAST(floor(sk_tiempo / 20000) AS INT) AS STRING)) AS codigo_toma,
       CASE WHEN sk_tiempo % 30000 >= 20000 THEN NULL ELSE DATE '{AS_OF}' END AS fecha_inicio, 'Jefe' AS responsable,
       CASE WHEN sk_tiempo % 50000 < 10000 THEN 'Abierta' ELSE 'Completada' END AS estado
FROM inv_fact WHERE sk_tiempo <> 19970000 + 1231""", ["inv_fact"]),
    "inv_count_line": ("""
SELECT sk_tiempo AS id_toma, sk_producto AS id_producto, sk_marca AS id_bodega,
       CAST(cantidad_fisica - CASE WHEN sk_producto % 50 = 7 THEN 1000 ELSE 0 END AS DECIMAL(12,2)) AS cantidad_fisica,
       CASE WHEN sk_producto % 61 <> 0 THEN cantidad_sistema END AS cantidad_sistema, observacion_texto AS observacion
FROM inv_fact
UNION ALL SELECT sk_tiempo, sk_producto, sk_marca, cantidad_fisica, cantidad_sistema, 'repetida' FROM inv_fact WHERE sk_producto % 40 = 3""",
                       ["inv_fact"]),
    "inv_store": ("""
SELECT DISTINCT sk_marca AS id_bodega, marca AS codigo_bodega, concat('Bodega ', marca) AS nombre,
       CASE WHEN sk_marca % 3 = 0 THEN 'Refrigerada' ELSE 'General' END AS tipo_almacenaje
FROM inv_product WHERE sk_marca <> 4""", ["inv_product"]),
    # Documents as received files.
    "inv_file": ("""
SELECT doc_id AS id_archivo_log,
       concat(CASE WHEN doc_id % 11 = 0 THEN '~$' ELSE '' END, source, '_', CAST(doc_id AS STRING),
              CASE WHEN doc_id % 5 = 0 THEN '.csv' ELSE '.xlsx' END) AS nombre_archivo,
       md5(text) AS hash_md5, CAST(n_chars AS BIGINT) AS caracteres
FROM documents""", []),
    "inv_file_event": ("""
SELECT id_archivo_log, 1 AS evento, nombre_archivo, hash_md5, 'En Proceso' AS estado,
       CAST(0 AS BIGINT) AS total_filas_raw, CAST(NULL AS STRING) AS mensaje
FROM inv_file
UNION ALL
SELECT id_archivo_log, 2, nombre_archivo, hash_md5,
       CASE WHEN id_archivo_log % 9 = 0 THEN 'Error' ELSE 'Procesado' END, caracteres,
       CASE WHEN id_archivo_log % 9 = 0 THEN 'hojas no reconocidas' END
FROM inv_file WHERE id_archivo_log % 10 <> 3""", ["inv_file"]),
    # Sheets per workbook: aliases, repeats of a kind, unknown names.
    "inv_workbook": ("""
SELECT DISTINCT o_custkey AS id_archivo,
       CASE CAST(o_orderkey % 8 AS INT) WHEN 0 THEN 'Fertilisa' WHEN 1 THEN 'Manvert, Jiffy'
            WHEN 2 THEN 'Manvert,Jiffy' WHEN 3 THEN 'Manvert Jiffy' WHEN 4 THEN 'LISTA DE PRODUCTOS'
            WHEN 5 THEN 'EJEMPLO DATOS KARDEX' WHEN 6 THEN 'Hoja1' ELSE 'fertilisa' END AS hoja
FROM orders""", []),
    # Appended control rows of the load processes, one per year of data seen.
    "inv_control": ("""
SELECT 'ETL_FACT_INVENTARIO' AS nombre_proceso, CAST(year(l_shipdate) - 1994 AS INT) AS total_cargas,
       CASE WHEN year(l_shipdate) > 1999 THEN 'Error' ELSE 'Completado' END AS estado_ultimo,
       CAST(max(l_shipdate) AS DATE) AS ultima_fecha_dato
FROM lineitem GROUP BY year(l_shipdate)
UNION ALL
SELECT 'ETL_DIM_PRODUCTO', CAST(year(l_shipdate) - 1994 AS INT), 'Completado', CAST(max(l_shipdate) AS DATE)
FROM lineitem GROUP BY year(l_shipdate)""", []),
}


def with_inputs(*names: str) -> str:
    """WITH clause that defines the named inputs and the ones they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in INPUTS[name][1]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({INPUTS[n][0]})" for n in ordered)


class Inputs:
    """Test tables and the inputs derived from them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        """A table; its schema is read once however often a query uses it."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._select(name, {})

    def _select(self, name: str, where: dict[str, str]) -> DataFrame:
        """Input by name; ``where`` adds a filter that reaches the scan of a table."""
        inputs = with_inputs(name)
        used = [t for t in TABLES if f"FROM {t}" in inputs or f"JOIN {t}" in inputs]
        tables = ",\n".join(
            f"{t} AS (SELECT * FROM {{{t}}}{' WHERE ' + where[t] if t in where else ''})" for t in used)
        text = f"WITH {tables},\n{inputs.removeprefix('WITH ')} SELECT * FROM {name}"
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def count_of(self, year: int = COUNT_YEAR) -> DataFrame:
        """One yearly count; the year is a range of days the scan can skip by."""
        days = f"l_shipdate >= DATE '{year}-01-01' AND l_shipdate < DATE '{year + 1}-01-01'"
        return self._select("inv_fact", {"lineitem": days})

    def sheet(self, kind: str) -> DataFrame:
        """Cleaned positional rows of one kind of sheet."""
        name = {"principal": "inv_sheet", "lotes": "inv_lots", "catalogo": "inv_catalogue",
                "movimientos": "inv_kardex"}[kind]
        raw = self[name]
        cells = [F.col(f"c{i}") if f"c{i}" in raw.columns else F.lit(None).cast("string") for i in range(SHEET_WIDTH)]
        keys = ["id_archivo", "id_carga", "fila_excel"]
        return positional(raw.select(*keys, F.array(*cells).alias("celdas")), kind)

    def dates(self) -> DataFrame:
        known = date_dimension(self.spark, "1995-01-01", "2001-12-31")
        return known.unionByName(unknown_date(self.spark).select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in known.schema]))

    def causes(self) -> DataFrame:
        return discrepancy_types(self.spark)
