"""Positional, all-text count sheets.

A sheet comes as lines of comma-separated cells, in double quotes where a cell holds a comma or a quote. A line starts with
the row's number in the sheet; in a workbook of several sheets the sheet's name comes first. A cell that holds a real
date is written as a date-time (``2026-08-15T00:00:00``) and read as its day; any other cell is text.

Lines are read one by one, so that a large file is split among tasks. Nothing of a line is lost: cells beyond the
sheet's width, and whole lines that cannot be read (a quote that is not closed, a row number that is none), are kept
aside in ``rescatado``. A short line lacks its last cells, as sheets leave them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions.cells import clean_cell, date_cell
from tallystock.sources.seeds import literal_table

# Column positions per kind of sheet, and the first row that holds data.
LAYOUTS = {
    "principal": ({"col_a_raw": 0, "codigo_raw": 1, "nombre_raw": 2, "fisico_raw": 3, "sistema_raw": 4,
                   "diferencia_raw": 5, "observacion_raw": 6}, 4),
    # Positions 9 and 10 hold a broken reference and nothing; they are never read.
    "lotes": ({"lote_raw": 0, "codigo_raw": 1, "nombre_raw": 2, "estado_lote_raw": 3, "fisico_raw": 4,
               "sistema_raw": 5, "diferencia_raw": 6, "observacion_raw": 7, "fecha_venc_raw": 8,
               "almacenaje_raw": 11}, 4),
    "catalogo": ({"codigo_raw": 0, "descripcion_raw": 1, "precio1_raw": 2, "precio2_raw": 3, "precio3_raw": 4,
                  "existencia_raw": 5}, 2),
    "movimientos": ({"tipo_raw": 0, "fecha_raw": 1, "documento_raw": 2, "cliente_prov_raw": 3, "costo_raw": 4,
                     "entradas_raw": 5, "precio_raw": 6, "salidas_raw": 7, "bodega_raw": 8,
                     "cantidad_toma_raw": 9}, 2),
}
SHEET_WIDTH = 12


_CELL = r',("[^"]*+(?:""[^"]*+)*+"|(?!")[^,]*+)'
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?$"


def split_line(line: Column) -> Column:
    """The cells of a line, still in their quotes; a line without quotes is cut at its commas."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def unquoted(cell: Column) -> Column:
    inside = F.substring(cell, F.lit(2), F.length(cell) - 2)
    return F.when(cell.startswith('"'), F.replace(inside, F.lit('""'), F.lit('"'))).otherwise(cell)


def typed_cell(c: Column) -> Column:
    """The text of a cell; a date-time becomes the text of its day."""
    is_date = (F.substring(c, 11, 1) == "T") & c.rlike(_DATE_TIME)
    return F.when(is_date, F.coalesce(date_cell(F.when(is_date, c).try_cast("timestamp_ntz")), c)).otherwise(c)


def positional(df: DataFrame, kind: str, cells: str = "celdas") -> DataFrame:
    """Named, trimmed cells from an array of cells; a short row gives nulls."""
    layout, first_row = LAYOUTS[kind]
    named = [clean_cell(F.get(F.col(cells), F.lit(i))).alias(name) for name, i in layout.items()]
    keep = [c for c in df.columns if c != cells]
    return df.where(F.col("fila_excel") >= first_row).select(*keep, *named)


def read_lines(spark: SparkSession, path: str | list[str], leading: int, files: DataFrame | None = None) -> DataFrame:
    """Rows (ruta, guia, fila_excel, celdas, rota, rescatado) of text files, one for each line; of ``files`` (ruta) alone if given.

    ``guia`` holds the ``leading`` cells before the row number, ``celdas`` the cells of the sheet. ``rota`` marks lines that
    cannot be read; their row number is null and ``rescatado`` holds them whole.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("ruta"), "value")
    if files is not None:
        lines = lines.join(files.select("ruta"), "ruta", "left_semi")
    lines = lines.withColumn("_cells", split_line(F.col("value")))
    # Cells that do not make up the line again have left something out.
    quotes = F.col("value").contains('"')
    whole = lines.withColumn("_whole", ~quotes | (F.array_join("_cells", ",") == F.col("value"))).withColumn(
        "_cells", F.when(quotes, F.transform("_cells", unquoted)).otherwise(F.col("_cells")))
    row = F.when(F.col("_whole"), F.trim(F.get("_cells", F.lit(leading))).try_cast("int"))
    found = whole.withColumn("fila_excel", row).withColumn("rota", F.col("fila_excel").isNull())
    width = leading + 1 + SHEET_WIDTH
    beyond = F.when(F.size("_cells") > width, F.array_join(F.slice("_cells", F.lit(width + 1), F.size("_cells")), ","))
    inside = F.slice("_cells", leading + 2, SHEET_WIDTH)
    return found.select(
        "ruta", F.slice("_cells", 1, leading).alias("guia"), "fila_excel",
        F.when(F.col("value").rlike("[0-9]T[0-9]"), F.transform(inside, typed_cell)).otherwise(inside).alias("celdas"), "rota",
        F.when(F.col("rota"), F.col("value")).otherwise(beyond).alias("rescatado"))


def scan_sheet(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Sheets exported as text, one file per sheet, row number first. Lines that cannot be read are left out here;
    ``read_lines`` has them."""
    raw = read_lines(spark, path, 0).where(~F.col("rota"))
    file_name = F.element_at(F.split("ruta", "/"), -1)
    return positional(raw.select(file_name.alias("archivo"), "fila_excel", "rescatado", "celdas"), kind)


def scan_workbooks(spark: SparkSession, path: str | list[str], files: DataFrame | None = None) -> DataFrame:
    """Rows (ruta, hoja, fila_excel, celdas, rota, rescatado) of workbooks exported as text, sheet name and row number first.

    ``files`` (ruta) picks some of a folder: a list of paths costs the driver a call and a listing for each.
    """
    return read_lines(spark, path, 1, files).select(
        "ruta", F.get("guia", F.lit(0)).alias("hoja"), "fila_excel", "celdas", "rota", "rescatado")


def aliases(kind: str) -> list[str]:
    """The names a sheet of a kind goes by."""
    return [name for name, own in V.SHEET_ALIASES if own == kind]


def route_sheets(sheets: DataFrame, file_key: str = "id_archivo", name: str = "hoja") -> DataFrame:
    """Kind and fate of each sheet: ``procesar``, ``repetida`` (a later alias) or ``desconocida``."""
    rows = [(i, alias, kind) for i, (alias, kind) in enumerate(V.SHEET_ALIASES)]
    aliases = literal_table(sheets.sparkSession, rows, f"orden int, {name} string, tipo string")
    known = sheets.join(F.broadcast(aliases), name, "left")
    first = known.where(F.col("tipo").isNotNull()).groupBy(file_key, "tipo").agg(F.min("orden").alias("primero"))
    fate = (F.when(F.col("tipo").isNull(), "desconocida")
            .when(F.col("orden") == F.col("primero"), "procesar").otherwise("repetida"))
    return known.join(first, [file_key, "tipo"], "left").select(file_key, name, "tipo", fate.alias("destino"))


def missing_sheets(sheets: DataFrame, file_key: str = "id_archivo", name: str = "hoja") -> DataFrame:
    """Expected sheet names a file does not hold."""
    expected = F.explode(F.array(*[F.lit(alias) for alias, _ in V.SHEET_ALIASES])).alias(name)
    return sheets.select(file_key).distinct().select(file_key, expected).join(
        sheets.select(file_key, name), [file_key, name], "left_anti")
