"""Landing flags, warnings, rule codes and constraint reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions import cells
from tallystock.operators.filters import row_kind
from tallystock.operators.windows import fill_down
from tallystock.plans.constraints import Check, constraint_checks, declared_checks, quarantine  # noqa: F401
from tallystock.session import materialize
from tallystock.sources.tables import mapped_rows


def _has(c: Column) -> Column:
    return c.isNotNull()


READY = {
    "principal": ["lnd_tiene_codigo", "lnd_tiene_nombre", "lnd_fisico_numerico"],
    "lotes": ["lnd_tiene_codigo", "lnd_tiene_nombre", "lnd_fisico_numerico"],
    "catalogo": ["lnd_tiene_codigo", "lnd_tiene_descripcion"],
    "movimientos": ["lnd_tiene_tipo", "lnd_fecha_parseable", "lnd_tipo_reconocido"],
}


def flags(kind: str) -> dict[str, Column]:
    """Quality flags of a landing row with cleaned cells."""
    c = F.col
    if kind == "catalogo":
        return {
            "lnd_tiene_codigo": _has(cells.clean_code(c("codigo_raw"))),
            "lnd_tiene_descripcion": _has(cells.clean_name(c("descripcion_raw"))),
            "lnd_precio1_numerico": cells.is_numeric(c("precio1_raw")),
            "lnd_existencia_numerica": cells.is_numeric(c("existencia_raw")),
        }
    if kind == "movimientos":
        return {
            "lnd_tiene_tipo": _has(c("tipo_raw")),
            "lnd_fecha_parseable": cells.is_date_parseable(c("fecha_raw")),
            "lnd_entradas_numericas": cells.is_numeric(c("entradas_raw")),
            "lnd_salidas_numericas": cells.is_numeric(c("salidas_raw")),
            "lnd_tipo_reconocido": F.coalesce(c("tipo_raw").isin(V.MOVEMENT_TYPES), F.lit(False)),
        }
    out = {
        "lnd_tiene_codigo": _has(cells.clean_code(c("codigo_raw"))),
        "lnd_tiene_nombre": _has(cells.clean_name(c("nombre_raw"))),
        "lnd_fisico_numerico": cells.is_numeric(c("fisico_raw")),
        "lnd_sistema_numerico": cells.is_numeric(c("sistema_raw")),
    }
    if kind == "lotes":
        out["lnd_fecha_venc_parseable"] = cells.is_date_parseable(c("fecha_venc_raw"))
        out["lnd_almacenaje_numerico"] = cells.is_numeric(c("almacenaje_raw"))
    return out


def with_flags(rows: DataFrame, kind: str) -> DataFrame:
    """Flags, then the ready mark read from them, so that no test runs twice."""
    ready = reduce(lambda a, b: a & b, [F.col(n) for n in READY[kind]])
    return rows.withColumns(flags(kind)).withColumn("lnd_listo_para_stg", ready)


def prepared_rows(rows: DataFrame, kind: str) -> DataFrame:
    """Cells that are rewritten before they are stored."""
    if kind == "lotes":
        return rows.withColumns({
            "estado_lote_raw": cells.normalize_lot_state(F.col("estado_lote_raw")),
            "fecha_venc_raw": cells.null_tokens(F.col("fecha_venc_raw")),
        })
    if kind == "movimientos":
        return rows.withColumn("documento_raw", cells.clean_code(F.col("documento_raw")))
    return rows


def classify_rows(sheet: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """All rows of one kind of sheet with their kind (``tipo_fila``); main sheets with the section carried down."""
    rows = sheet.withColumn("tipo_fila", row_kind(kind))
    if kind == "principal":
        # A section row sits among rows that are neither empty nor headers.
        title = F.when(F.col("tipo_fila") == "seccion", cells.section_name(F.col("codigo_raw")))
        rows = fill_down(rows.withColumn("_title", title), "_title", keys, "fila_excel", "categoria_raw").drop("_title")
    return rows


def land(sheet: DataFrame, kind: str, keys: list[str] | None = None) -> DataFrame:
    """Landing rows of one kind of sheet: cleaned cells, section carried down, flags.

    Empty, header and section rows are counted by ``row_counters`` but not stored.
    """
    rows = classify_rows(sheet, kind, keys or ["id_carga"])
    data = prepared_rows(rows.where(F.col("tipo_fila") == "dato").drop("tipo_fila"), kind)
    if kind in ("principal", "lotes"):
        data = data.withColumns({"es_fila_seccion": F.lit(False), "es_fila_vacia": F.lit(False)})
    return with_flags(data, kind)


def row_counters(sheet: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """Rows read, empty, section, header and inserted, and warnings raised, in one pass."""
    rows = with_flags(prepared_rows(sheet.withColumn("tipo_fila", row_kind(kind)), kind), kind)
    k = F.col("tipo_fila")
    raised = F.when(k == "dato", sum((F.when(c, 1).otherwise(0) for _, _, c, _ in warning_rules(kind)), F.lit(0)))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("leidas"), F.count_if(k == "vacia").alias("vacias"),
        F.count_if(k == "seccion").alias("secciones"), F.count_if(k == "encabezado").alias("encabezados"),
        F.count_if(k == "dato").alias("insertadas"),
        F.coalesce(F.sum(raised), F.lit(0).cast("bigint")).alias("warnings"))


def load_sheet(sheet: DataFrame, kind: str, path: str, keys: list[str], load: str = "id_carga") -> DataFrame:
    """Land one kind of sheet into its table and give one load row per sheet.

    The rows are stored once, so that table and log count the same ones, and written by load: a
    load that is run again replaces its own rows. A kind that fails is logged as ``Error`` with
    its message and does not stop the others.
    """
    zero = {n: F.lit(0).cast("bigint") for n in ["leidas", "vacias", "secciones", "encabezados", "insertadas", "warnings"]}
    try:
        stored = materialize(sheet, "sheet")
        landed = land(stored, kind, keys)
        landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(load).parquet(path)
    except Exception as failure:  # noqa: BLE001
        log = sheet.select(*keys).distinct().withColumns(zero)
        return log.withColumns({"estado": F.lit("Error"), "mensaje_error": F.lit(str(failure))})
    log = row_counters(stored, kind, keys)
    return log.withColumns({"estado": F.lit("Completado"), "mensaje_error": F.lit(None).cast("string")})


# Load log column -> staging column. Empty rows are stored as rejected ones.
STAGING_LOAD = {
    "id_carga": ("id_carga", "bigint"), "nombre_archivo": ("nombre_archivo", "string"), "hoja_procesada": ("hoja", "string"),
    "filas_leidas": ("total_filas_raw", "int"), "filas_vacias": ("filas_rechazadas", "int"),
    "filas_insertadas": ("filas_validas", "int"), "estado": ("estado", "string"),
}


def staging_loads(loads: DataFrame, files: DataFrame, file_key: str = "id_archivo") -> DataFrame:
    """Load rows in the shape of the staging table, with the file name from the file log."""
    named = loads.join(files.select(file_key, "nombre_archivo"), file_key)
    return mapped_rows(named, STAGING_LOAD)


def warning_rules(kind: str) -> list[tuple[str, str, Column, Column]]:
    """(rule, field, condition, received value) per warning of a landed row."""
    c = F.col
    if kind == "catalogo":
        price = c("precio1_raw")
        return [("PRECIO_CERO", "precio1_raw", price.isNull() | (price == "0"), price)]
    if kind == "movimientos":
        return [
            ("RV-14", "tipo_raw", c("lnd_tiene_tipo") & ~c("lnd_tipo_reconocido"), c("tipo_raw")),
            ("FECHA", "fecha_raw", ~c("lnd_fecha_parseable"), c("fecha_raw")),
        ]
    no_system = ~c("lnd_sistema_numerico") & c("fisico_raw").isNotNull()
    rules = [("RV-04", "sistema_raw", no_system, c("sistema_raw"))]
    if kind == "lotes":
        rules.append(("FECHA_VENC", "fecha_venc_raw", ~c("lnd_fecha_venc_parseable"), c("fecha_venc_raw")))
    return rules + [
        ("RV-02", "nombre_raw", c("lnd_tiene_codigo") & ~c("lnd_tiene_nombre"), c("nombre_raw")),
        ("RV-01", "codigo_raw", c("lnd_tiene_nombre") & ~c("lnd_tiene_codigo"), c("codigo_raw")),
    ]


def warning_mask(kind: str) -> Column:
    """The warnings of a landed row as one number; bit i stands for rule i of ``warning_rules``."""
    return sum((F.when(condition, 1 << bit).otherwise(0) for bit, (_, _, condition, _) in enumerate(warning_rules(kind))), F.lit(0))


def warnings(landed: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """Error-log rows: one per landed row and warning it raises.

    Rows without a warning are gone before anything is generated; the others are repeated once for each bit of their mask.
    """
    rules = warning_rules(kind)
    fields = [f for f in sorted({field for _, field, _, _ in rules}) if f not in keys]
    if "lnd_avisos" in landed.columns:  # stored with the row: the filter reaches the scan
        raised = landed.select(*keys, *fields, "lnd_avisos").where(F.col("lnd_avisos") > 0)
    else:
        # A filter in front of the flags would compute each of them anew for every use; the id keeps it behind them.
        masked = landed.select(*keys, *fields, warning_mask(kind).alias("lnd_avisos"), F.monotonically_increasing_id().alias("_id"))
        raised = masked.where((F.col("lnd_avisos") > 0) & (F.col("_id") >= 0)).drop("_id")
    table = F.array(*[F.struct(F.lit(1 << bit).alias("_bit"), F.lit(rule).alias("regla_violada"), F.lit(field).alias("campo_erroneo"))
                      for bit, (rule, field, _, _) in enumerate(rules)])
    rows = raised.select("*", F.inline(F.filter(table, lambda e: F.col("lnd_avisos").bitwiseAND(e["_bit"]) != 0)))
    value = F.coalesce(*[F.when(F.col("_bit") == 1 << bit, received) for bit, (_, _, _, received) in enumerate(rules)])
    return rows.select(*keys, "regla_violada", "campo_erroneo", value.alias("valor_recibido"), F.lit("WARNING").alias("severidad"))


def ready_rows(landed: DataFrame, loads: DataFrame, kind: str) -> DataFrame:
    """Rows the staging step takes: ready, trimmed, with the period of their load."""
    trimmed = ["fisico_raw", "sistema_raw", "diferencia_raw", "observacion_raw"]
    codes = {"codigo_limpio": "codigo_raw"}
    plain = ["fila_excel"]
    if kind == "lotes":
        trimmed += ["estado_lote_raw", "fecha_venc_raw", "almacenaje_raw"]
        codes = {"lote_limpio": "lote_raw", **codes}
        plain.append("lnd_fecha_venc_parseable")
    else:
        plain.append("categoria_raw")
    ready = landed.where(F.col("lnd_listo_para_stg") & ~F.col("es_fila_seccion") & ~F.col("es_fila_vacia"))
    return ready.join(loads.select("id_carga", "periodo_datos"), "id_carga").select(
        "id_carga", "periodo_datos",
        *[cells.clean_code_view(F.col(raw)).alias(name) for name, raw in codes.items()],
        F.trim("nombre_raw").alias("nombre_limpio"),
        *[F.trim(c).alias(c) for c in trimmed],
        *plain,
    )


def rule_code(code: Column, name: Column, physical: Column, system: Column, difference: Column) -> Column:
    """First rule that hits, on the typed quantities before empty ones are set to zero."""
    def empty(c: Column) -> Column:
        return c.isNull() | (c == "")

    gap = F.abs((physical - system) - difference) > F.lit(0.01).cast("decimal(3,2)")
    return (
        F.when(empty(code), V.RULE_NO_CODE)
        .when(physical < 0, V.RULE_NEGATIVE)
        .when(empty(name), V.RULE_NO_NAME)
        .when(system.isNull(), V.RULE_NO_SYSTEM)
        .when(gap, V.RULE_MISMATCH)
        .otherwise(V.RULE_OK)
    )


def clean_counts(rows: DataFrame) -> DataFrame:
    """The cleaning step: typed quantities, rule code, then zero for empty quantities.

    The text of each quantity stays in ``<name>_raw``; a failed conversion is null.
    """
    quantities = ["fisico", "sistema", "diferencia"]
    typed = rows.withColumns({q: cells.text_to_number(F.col(f"{q}_raw")) for q in quantities})
    coded = typed.withColumn("error_column", rule_code(
        F.col("codigo_limpio"), F.col("nombre_limpio"), F.col("fisico"), F.col("sistema"), F.col("diferencia")))
    return coded.withColumns({q: cells.zero_fill(F.col(q)) for q in ["fisico", "sistema"]})
