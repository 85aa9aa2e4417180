"""Workbooks written from the test tables, and the queries over a run that lands them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock.catalog.inputs import AS_OF, LOT_SHEET, Inputs, with_inputs
from tallystock.catalog.quality_sql import CATALOGUE, KARDEX, LOTS, MAIN
from tallystock.catalog.registry import query
from tallystock.plans.file_run import COUNTERS, KINDS, NO_SHEETS, Area, load_status, process_files
from tallystock.plans.quality import staging_loads
from tallystock.session import materialize, new_path
from tallystock.sources.files import discover_files, input_paths
from tallystock.sources.sheets import aliases, positional, scan_workbooks

# Every third workbook comes a second time under another name; every fourth is open, and has a lock file.
_BOOKS = f"""{with_inputs('inv_book_line')}, book AS (
SELECT id_archivo, concat('Resumen_', CAST(id_archivo AS VARCHAR), '.xlsx') AS nombre_archivo,
       concat(string_agg(linea, chr(10) ORDER BY orden, fila_excel, linea), chr(10)) AS texto
FROM inv_book_line GROUP BY id_archivo),
received AS (SELECT id_archivo, nombre_archivo, texto, FALSE AS copia FROM book
UNION ALL SELECT id_archivo, replace(nombre_archivo, '.xlsx', '_copia.xlsx'), texto, TRUE FROM book WHERE id_archivo % 3 = 0)"""

_UNREADABLE = "1 filas ilegibles, la primera: EJEMPLO DATOS KARDEX,99999,\"sin cierre"
_COUNTS = """count(*) AS leidas, count(*) FILTER (tipo_fila = 'vacia') AS vacias, count(*) FILTER (tipo_fila = 'seccion') AS secciones,
  count(*) FILTER (tipo_fila = 'encabezado') AS encabezados, count(*) FILTER (tipo_fila = 'dato') AS insertadas"""
_COUNT_WARNINGS = """CASE WHEN NOT lnd_sistema_numerico AND fisico_raw IS NOT NULL THEN 1 ELSE 0 END
  + CASE WHEN lnd_tiene_codigo <> lnd_tiene_nombre THEN 1 ELSE 0 END"""
# What a run over the workbooks leaves: a load for each known sheet, and the state of each file.
RUN = f"""{_BOOKS}, {MAIN}, {LOTS}, {CATALOGUE}, {KARDEX},
known_sheets AS (SELECT DISTINCT id_archivo, 'principal' AS tipo, 1 AS n, 'Fertilisa' AS hoja, FALSE AS mala FROM inv_sheet
  UNION ALL SELECT DISTINCT id_archivo, 'lotes', 2, {LOT_SHEET}, FALSE FROM inv_lots
  UNION ALL SELECT DISTINCT id_archivo, 'catalogo', 3, 'LISTA DE PRODUCTOS', FALSE FROM inv_catalogue
  UNION ALL SELECT DISTINCT id_archivo, 'movimientos', 4, 'EJEMPLO DATOS KARDEX', id_archivo % 6 = 1 FROM inv_kardex WHERE id_archivo % 5 <> 3),
row_counts AS (SELECT id_archivo, tipo, {_COUNTS} FROM (
    SELECT id_archivo, 'principal' AS tipo, tipo_fila FROM main_kind UNION ALL SELECT id_archivo, 'lotes', tipo_fila FROM lots_kind
    UNION ALL SELECT id_archivo, 'catalogo', tipo_fila FROM cat_kind UNION ALL SELECT id_archivo, 'movimientos', tipo_fila FROM kar_kind) k
  GROUP BY id_archivo, tipo),
row_warnings AS (SELECT id_archivo, tipo, CAST(sum(w) AS BIGINT) AS warnings FROM (
    SELECT id_archivo, 'principal' AS tipo, {_COUNT_WARNINGS} AS w FROM main_landed
    UNION ALL SELECT id_archivo, 'lotes', {_COUNT_WARNINGS} + CASE WHEN NOT lnd_fecha_venc_parseable THEN 1 ELSE 0 END FROM lots_landed
    UNION ALL SELECT id_archivo, 'catalogo', CASE WHEN precio1_raw IS NULL OR precio1_raw = '0' THEN 1 ELSE 0 END FROM cat_landed
    UNION ALL SELECT id_archivo, 'movimientos', CASE WHEN lnd_tiene_tipo AND NOT lnd_tipo_reconocido THEN 1 ELSE 0 END
      + CASE WHEN NOT lnd_fecha_parseable THEN 1 ELSE 0 END FROM kar_landed) x GROUP BY id_archivo, tipo),
run_loads AS (SELECT b.id_archivo, CAST(concat('0x', substr(md5(texto), 1, 14)) AS BIGINT) * 10 + n AS id_carga, nombre_archivo, hoja, tipo, mala,
    strftime(DATE '{AS_OF}', '%Y-%m') AS periodo_datos, CASE WHEN mala THEN 'Error' ELSE 'Completado' END AS estado,
    {", ".join(f"CASE WHEN mala THEN 0 ELSE coalesce({c}, 0) END AS {c}" for c in COUNTERS)},
    CASE WHEN mala THEN '{_UNREADABLE}' END AS mensaje
  FROM known_sheets JOIN book b USING (id_archivo) LEFT JOIN row_counts USING (id_archivo, tipo) LEFT JOIN row_warnings USING (id_archivo, tipo)),
run_files AS (SELECT nombre_archivo, md5(texto) AS hash_md5, CAST(strlen(texto) AS BIGINT) AS tamanio_bytes,
    CASE WHEN coalesce(ok, FALSE) THEN 'Procesado' ELSE 'Error' END AS estado, coalesce(leidas, 0) AS total_filas_raw,
    coalesce(insertadas, 0) AS total_insertadas, CASE WHEN ok IS NULL THEN '{NO_SHEETS}' END AS mensaje
  FROM book LEFT JOIN (SELECT id_archivo, bool_or(NOT mala) AS ok, CAST(sum(leidas) AS BIGINT) AS leidas,
    CAST(sum(insertadas) AS BIGINT) AS insertadas FROM run_loads GROUP BY id_archivo) l USING (id_archivo))"""
_NAMED_COUNTS = {"leidas": "filas_leidas", "vacias": "filas_vacias", "secciones": "filas_seccion", "encabezados": "filas_encabezado",
                 "insertadas": "filas_insertadas", "warnings": "warnings"}
_RENAMED = ", ".join(f"{a} AS {b}" for a, b in _NAMED_COUNTS.items())


class _Killed(Exception):
    """Stands for the loss of the driver between two sheets."""


def write_workbooks(t: Inputs) -> str:
    """A folder below the shared one with the workbooks as text files."""
    spark = t.spark
    lines = materialize(t["inv_book_line"], "book-lines")
    resumen = F.concat(F.lit("Resumen_"), F.col("id_archivo").cast("string"))
    named = [
        lines.withColumn("archivo", F.concat(resumen, F.lit(".xlsx"))),
        lines.where("id_archivo % 3 = 0").withColumn("archivo", F.concat(resumen, F.lit("_copia.xlsx"))),
        lines.select("id_archivo").where("id_archivo % 4 = 0").distinct().select(
            "id_archivo", F.lit(0).alias("orden"), F.lit(0).alias("fila_excel"), F.lit("lock").alias("linea"),
            F.concat(F.lit("~$"), resumen, F.lit(".xlsx")).alias("archivo")),
        lines.select("id_archivo").where("id_archivo % 4 = 0").distinct().select(
            "id_archivo", F.lit(0).alias("orden"), F.lit(0).alias("fila_excel"), F.lit("texto").alias("linea"),
            F.concat(resumen, F.lit(".csv")).alias("archivo")),
    ]
    every = named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])
    parts, folder = new_path(spark, "workbook-parts"), new_path(spark, "workbooks")
    every.repartition("archivo").sortWithinPartitions("archivo", "orden", "fila_excel", "linea").select("archivo", "linea").write.option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("archivo").text(parts)  # tasks move their files, not the driver
    _name_files(spark, parts, folder)
    return folder


def _name_files(spark: SparkSession, parts: str, folder: str) -> None:
    """``parts/archivo=<name>/<one file>`` becomes ``folder/<name>``. The listing comes in one call, and files are renamed side by side."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    written = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(parts)

    def rename(source: str) -> None:
        name = source.rsplit("/", 2)[1].removeprefix("archivo=")
        if not fs.rename(path(source), path(f"{folder}/{name}")):
            raise OSError(f"could not name {name}")
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(rename, input_paths(written)))


_runs: dict[tuple[str, str], tuple[str, str]] = {}


def landed_area(t: Inputs) -> tuple[Area, str]:
    """The area of a finished run over the workbooks, and their folder. The run is killed before the lot sheets are landed and started
    again; queries of one application share it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _runs:
        folder, base = write_workbooks(t), new_path(t.spark, "landing-area")

        def kill(kind: str) -> None:
            if kind == "lotes":
                raise _Killed
        try:
            process_files(t.spark, folder, base, AS_OF, between=kill)
        except _Killed:
            pass
        summary = process_files(t.spark, folder, base, AS_OF)
        summary.write.parquet(f"{base}/resumen")
        _runs[key] = base, folder
    base, folder = _runs[key]
    return Area(t.spark, base), folder


def run_counts(t: Inputs) -> DataFrame:
    area, _ = landed_area(t)
    return t.spark.read.parquet(f"{area.base}/resumen")


@query("discover_files", f"""{_BOOKS}
SELECT nombre_archivo, md5(texto) AS hash_md5, CAST(strlen(texto) AS BIGINT) AS tamanio_bytes FROM received""")
def _discover(t: Inputs) -> DataFrame:
    return discover_files(t.spark, landed_area(t)[1]).drop("ruta_origen")


@query("run_summary", f"""{RUN}
SELECT count(*) FILTER (estado = 'Procesado') AS exitosos, (SELECT count(*) FROM received WHERE copia) AS duplicados,
       count(*) FILTER (estado = 'Error') AS errores FROM run_files""")
def _summary(t: Inputs) -> DataFrame:
    return run_counts(t)


@query("file_log", f"{RUN} SELECT nombre_archivo, hash_md5, tamanio_bytes, estado, total_filas_raw, total_insertadas, mensaje FROM run_files")
def _file_log(t: Inputs) -> DataFrame:
    return landed_area(t)[0].files().select(
        "nombre_archivo", "hash_md5", "tamanio_bytes", "estado", "total_filas_raw", "total_insertadas", "mensaje")


@query("load_log", f"{RUN} SELECT id_carga, hoja, tipo, periodo_datos, estado, {_RENAMED}, mensaje FROM run_loads")
def _load_log(t: Inputs) -> DataFrame:
    return landed_area(t)[0].loads().select("id_carga", "hoja", "tipo", "periodo_datos", "estado", *COUNTERS, "mensaje").withColumnsRenamed(
        _NAMED_COUNTS)


def _visible(name: str, source: str) -> str:
    return f"SELECT id_archivo, '{name}' AS tipo, fila_excel, lnd_listo_para_stg FROM {source}"


@query("process_files", f"""{RUN}, visible AS ({" UNION ALL ".join(
    _visible(k, f"{s}_landed") for k, s in zip(KINDS, ["main", "lots", "cat", "kar"], strict=True))})
SELECT nombre_archivo, l.tipo, estado, CASE WHEN mala THEN 4 ELSE 2 END AS eventos, count(v.fila_excel) AS filas,
       coalesce(CAST(sum(v.fila_excel) AS BIGINT), 0) AS suma_filas, count(v.fila_excel) FILTER (lnd_listo_para_stg) AS listas
FROM run_loads l LEFT JOIN visible v ON v.id_archivo = l.id_archivo AND v.tipo = l.tipo AND NOT mala
GROUP BY nombre_archivo, l.tipo, estado, mala""")
def _process(t: Inputs) -> DataFrame:
    area, _ = landed_area(t)
    ready = F.col("lnd_listo_para_stg")
    rows = None
    for kind in KINDS:
        own = area.landed(kind).groupBy("id_carga").agg(
            F.count("*").alias("filas"), F.sum("fila_excel").alias("suma_filas"), F.count_if(ready).alias("listas"))
        rows = own if rows is None else rows.unionByName(own)
    events = area.load_events().groupBy("id_carga").agg(F.count("*").cast("int").alias("eventos"))
    named = area.files().select("id_archivo", "nombre_archivo")
    return area.loads().join(named, "id_archivo").join(events, "id_carga").join(rows, "id_carga", "left").fillna(
        0, ["filas", "suma_filas", "listas"]).select("nombre_archivo", "tipo", "estado", "eventos", "filas", "suma_filas", "listas")


@query("load_status_view", f"""{RUN}, ready AS (
SELECT 'principal' AS tipo, id_archivo, lnd_listo_para_stg FROM main_landed UNION ALL SELECT 'lotes', id_archivo, lnd_listo_para_stg FROM lots_landed)
SELECT id_carga, nombre_archivo, periodo_datos, hoja, {_RENAMED}, estado, mensaje,
       {", ".join(f"""(SELECT count(*) FROM ready r WHERE r.id_archivo = l.id_archivo AND r.tipo = l.tipo AND r.tipo = '{k}'
        AND {flag} lnd_listo_para_stg) AS {k}_{name}""" for k in ("principal", "lotes") for flag, name in (("", "listas"), ("NOT", "con_problemas")))}
FROM run_loads l""")
def _load_status(t: Inputs) -> DataFrame:
    found = load_status(landed_area(t)[0])
    return found.drop("id_archivo", "tipo", "momento").withColumnsRenamed(_NAMED_COUNTS)


@query("staging_loads", f"""{RUN}
SELECT id_carga, nombre_archivo, hoja, CAST(leidas AS INT) AS total_filas_raw, CAST(vacias AS INT) AS filas_rechazadas,
       CAST(insertadas AS INT) AS filas_validas, estado FROM run_loads""")
def _staging_loads(t: Inputs) -> DataFrame:
    area, _ = landed_area(t)
    return staging_loads(area.loads().withColumnsRenamed({**_NAMED_COUNTS, "hoja": "hoja_procesada"}), area.files())


def _cells(name: str, source: str, columns: dict[str, str]) -> str:
    raw = ["lote_raw", "codigo_raw", "nombre_raw", "descripcion_raw", "tipo_raw", "fecha_raw", "documento_raw", "estado_lote_raw", "fisico_raw",
           "sistema_raw", "diferencia_raw", "observacion_raw", "fecha_venc_raw", "almacenaje_raw", "precio1_raw", "existencia_raw",
           "entradas_raw", "salidas_raw"]
    return f"SELECT id_archivo, '{name}' AS tipo, fila_excel, " + ", ".join(
        f"{columns.get(c, 'NULL')} AS {c}" for c in raw) + f" FROM {source}"


_SAME = {c: c for c in ["codigo_raw", "nombre_raw", "fisico_raw", "sistema_raw", "diferencia_raw", "observacion_raw"]}
_SCANNED = " UNION ALL ".join([
    _cells("principal", "main_cells", _SAME),
    _cells("lotes", "lots_cells", _SAME | {"lote_raw": "lote_raw", "estado_lote_raw": "estado", "fecha_venc_raw": "venc", "almacenaje_raw": "almacenaje_raw"}),
    _cells("catalogo", "cat_cells", {c: c for c in ["codigo_raw", "descripcion_raw", "precio1_raw", "existencia_raw"]}),
    _cells("movimientos", "kar_cells", {"tipo_raw": "tipo_raw", "fecha_raw": "fecha_raw", "documento_raw": "nullif(trim(doc), '')",
                                        "entradas_raw": "entradas_raw", "salidas_raw": "salidas_raw"}),
])


@query("scan_sheet", f"""{RUN}, cells AS ({_SCANNED})
SELECT nombre_archivo, c.* EXCLUDE (id_archivo) FROM cells c JOIN book USING (id_archivo) WHERE NOT (tipo = 'movimientos' AND id_archivo % 5 = 3)""")
def _scan_sheet(t: Inputs) -> DataFrame:
    """All four layouts, read from the files; copies are left out, and lines that cannot be read are kept aside."""
    _, folder = landed_area(t)
    raw = scan_workbooks(t.spark, folder).where(F.col("ruta").endswith(".xlsx") & ~F.col("ruta").endswith("_copia.xlsx") & ~F.col("rota"))
    named = raw.select(F.element_at(F.split("ruta", "/"), -1).alias("nombre_archivo"), "hoja", "fila_excel", "celdas")
    named = materialize(named, "scanned")  # lines are cut into cells once, not once for each layout
    out = None
    for kind in KINDS:
        own = positional(named.where(F.col("hoja").isin(aliases(kind))).select("nombre_archivo", F.lit(kind).alias("tipo"), "fila_excel", "celdas"), kind)
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.drop("col_a_raw", "precio2_raw", "precio3_raw", "cliente_prov_raw", "costo_raw", "precio_raw", "bodega_raw", "cantidad_toma_raw")
