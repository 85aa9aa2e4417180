"""A run over received workbooks: discovery, duplicates, routing, landing, logs, summary.

Every file and every sheet load is a small state machine. Its changes are appended as events to two logs, and a state is
the last event of its key; nothing is updated in place. The logs are the manifest of the landing tables: the rows of loads that
are landed together share a folder (``tanda``), and readers see those of completed loads only, from the folder that the closing
event names. Rows are written first, replacing what an attempt before may have left in the same folder, and the closing events after
that, so a run that is killed at any point leaves nothing half visible and is continued by running it again: closed loads are kept,
open ones are landed anew. Ids come from the content of a file, so that both runs speak of the same loads.

All sheets of a kind are landed by one job, whose files grow with the rows and not with the loads. A sheet with lines that cannot
be read fails alone, before that job. If
the job itself fails, its loads are halved until the ones that fail stand alone; these get status ``Error``, the others are
landed. Counters are read from the rows that were stored, and have to add up to what was observed while they were written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystock.plans.quality import classify_rows, prepared_rows, warning_mask, with_flags
from tallystock.session import materialize
from tallystock.sources.files import dedupe_files_md5, discover_files, file_log, mark_files, run_summary
from tallystock.sources.sheets import LAYOUTS, aliases, positional, route_sheets, scan_workbooks

OPEN, DONE, LANDED, FAILED = "En Proceso", "Procesado", "Completado", "Error"
KINDS = list(LAYOUTS)
COUNTERS = ["leidas", "vacias", "secciones", "encabezados", "insertadas", "warnings"]
FILE_EVENT = ("id_archivo bigint, evento int, nombre_archivo string, ruta_origen string, hash_md5 string, tamanio_bytes bigint, "
              "estado string, total_filas_raw bigint, total_insertadas bigint, mensaje string, momento timestamp")
LOAD_EVENT = ("id_carga bigint, evento int, id_archivo bigint, hoja string, tipo string, periodo_datos string, estado string, "
              + ", ".join(f"{c} bigint" for c in COUNTERS) + ", mensaje string, momento timestamp, tanda string")
NO_SHEETS, NO_HASH = "Checklist pre-carga fallido: hojas no reconocidas", "archivo demasiado grande"


@dataclass
class Area:
    """The folders of a landing area and the readers of what is in them."""

    spark: SparkSession
    base: str
    _known: set[str] = field(default_factory=set)

    def _log(self, name: str, schema: str) -> DataFrame:
        path = f"{self.base}/{name}"
        if name not in self._known:  # an empty table, unless there is one
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
            self._known.add(name)
        return self.spark.read.schema(schema).parquet(path)

    def file_events(self) -> DataFrame:
        return self._log("log_archivos", FILE_EVENT)

    def load_events(self) -> DataFrame:
        return self._log("log_cargas", LOAD_EVENT)

    def files(self) -> DataFrame:
        """The state of every file."""
        return file_log(self.file_events(), "id_archivo")

    def loads(self) -> DataFrame:
        """The state of every sheet load."""
        return file_log(self.load_events(), "id_carga").drop("tanda")

    def path(self, kind: str) -> str:
        return f"{self.base}/{kind}"

    def stored(self, kind: str) -> DataFrame:
        """All rows of a kind that completed loads hold, with their kind of row."""
        states = file_log(self.load_events(), "id_carga")
        done = states.where((F.col("estado") == LANDED) & (F.col("tipo") == kind)).select("tanda", "id_carga")
        return self.spark.read.parquet(self.path(kind)).join(done, ["tanda", "id_carga"], "left_semi").drop("tanda")

    def landed(self, kind: str) -> DataFrame:
        """The landing rows of a kind."""
        return self.stored(kind).where(F.col("tipo_fila") == "dato").drop("tipo_fila")

    def append(self, events: DataFrame, log: str) -> None:
        """Add events, numbered after those that their keys have."""
        schema, key = (FILE_EVENT, "id_archivo") if log == "log_archivos" else (LOAD_EVENT, "id_carga")
        last = self._log(log, schema).groupBy(key).agg(F.max("evento").alias("_last"))
        numbered = events.join(last, key, "left").withColumn("evento", F.coalesce(F.col("_last"), F.lit(0)) + 1)
        wanted = self._log(log, schema).schema
        absent = {f.name: F.lit(None) for f in wanted if f.name not in numbered.columns}
        rows = numbered.withColumns(absent).select(*[F.col(f.name).cast(f.dataType) for f in wanted])
        rows.coalesce(1).write.mode("append").parquet(f"{self.base}/{log}")


def file_id(md5: Column) -> Column:
    """A number from the first 56 bits of the hash."""
    return F.conv(F.substring(md5, 1, 14), 16, 10).cast("bigint")


def load_id(file: Column, kind: Column) -> Column:
    return file * 10 + F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _counted(stored: DataFrame, by: list[str]) -> DataFrame:
    return stored.groupBy(*by).agg(*[c.alias(name) for name, c in _counter_columns().items()])


def _counter_columns() -> dict[str, Column]:
    of = lambda kind: F.count_if(F.col("tipo_fila") == kind)
    return {"leidas": F.count("*"), "vacias": of("vacia"), "secciones": of("seccion"), "encabezados": of("encabezado"),
            "insertadas": of("dato"), "warnings": F.coalesce(F.sum(F.bit_count("lnd_avisos")), F.lit(0)).cast("bigint")}


def prepare_rows(cells: DataFrame, kind: str) -> DataFrame:
    """All rows of one kind of sheet as they are stored: kind of row, cleaned cells, flags, mask of warnings."""
    rows = prepared_rows(classify_rows(positional(cells, kind), kind, ["id_carga"]), kind)
    flagged = with_flags(rows, kind)
    if kind in ("principal", "lotes"):
        flagged = flagged.withColumns({"es_fila_seccion": F.lit(False), "es_fila_vacia": F.lit(False)})
    return flagged.withColumn("lnd_avisos", F.when(F.col("tipo_fila") == "dato", warning_mask(kind)).otherwise(0))


def land_loads(cells: DataFrame, kind: str, path: str, prepare: Callable[[DataFrame, str], DataFrame] = prepare_rows) -> DataFrame:
    """Store the rows of some loads of one kind in the folder ``path``, and count them.

    Gives rows (id_carga, counters). Raises if the stored rows do not add up to what was written.
    """
    spark = cells.sparkSession
    written = Observation()
    rows = spark.sql("SELECT /*+ REBALANCE(id_carga) */ * FROM {rows}", rows=prepare(cells, kind))
    rows = rows.observe(written, *[c.alias(name) for name, c in _counter_columns().items()])
    rows.write.mode("overwrite").parquet(path)
    counted = materialize(_counted(spark.read.parquet(path), ["id_carga"]), "counted")
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]).first().asDict()
    if total != written.get:
        raise RuntimeError(f"stored rows {total} are not those written {written.get}")
    return counted


def _among(ids: list[int]) -> Column:
    """Loads of a stretch of the ids in order, where only such loads occur."""
    return F.col("id_carga").between(ids[0], ids[-1])


def batch_name(ids: list[int]) -> str:
    """The folder of loads that are landed together. Its first load is landed once, so no other batch that was closed has the name."""
    return f"t{ids[0]}"


def _land_isolated(cells: DataFrame, ids: list[int], kind: str, path: str, prepare: Callable) -> list[tuple[DataFrame | None, list[int], str | None]]:
    """Results (counters, loads, message) of landing ``ids``, all loads of ``cells`` in order; loads that fail stand alone, with their message."""
    try:
        own = cells.where(_among(ids))
        return [(land_loads(own, kind, f"{path}/tanda={batch_name(ids)}", prepare), ids, None)]
    except Exception as failure:  # noqa: BLE001  any failure of a load is its state, not the run's
        if len(ids) == 1:
            return [(None, ids, str(failure).strip().split("\n")[0][:500])]
        half = len(ids) // 2
        return (_land_isolated(cells, ids[:half], kind, path, prepare) + _land_isolated(cells, ids[half:], kind, path, prepare))


def _open_files(area: Area, folder: str, moment: Column) -> tuple[DataFrame, DataFrame]:
    """All files of the folder with ``duplicado``, and those to be processed, which are in state ``En Proceso`` then."""
    listed = discover_files(area.spark, folder).withColumn("id_archivo", file_id(F.col("hash_md5")))
    listed = materialize(listed, "listed")
    states = area.files()
    hashed = listed.where(F.col("hash_md5").isNotNull())
    accepted = materialize(dedupe_files_md5(hashed, states, "nombre_archivo"), "accepted")
    opened = states.where(F.col("estado") == OPEN).select("id_archivo")
    new = accepted.join(opened, "id_archivo", "left_anti")
    area.append(new.withColumns({"estado": F.lit(OPEN), "momento": moment}), "log_archivos")
    large = listed.where(F.col("hash_md5").isNull()).withColumn("id_archivo", F.xxhash64("ruta_origen"))
    area.append(large.withColumns({"estado": F.lit(FAILED), "mensaje": F.lit(NO_HASH), "momento": moment}), "log_archivos")
    return mark_files(hashed, accepted, "ruta_origen").unionByName(large.withColumn("duplicado", F.lit(False))), accepted


def _open_loads(area: Area, cells: DataFrame, accepted: DataFrame, period: str, moment: Column) -> DataFrame:
    """Loads (id_carga, id_archivo, hoja, tipo) of known sheets that are not landed yet, in state ``En Proceso``."""
    sheets = cells.select("id_archivo", "hoja").where(F.col("hoja").isNotNull()).distinct()
    routed = route_sheets(sheets).where(F.col("destino") == "procesar")
    loads = routed.select(load_id(F.col("id_archivo"), F.col("tipo")).alias("id_carga"), "id_archivo", "hoja", "tipo")
    states = area.loads()
    landed = states.where(F.col("estado") == LANDED).select("id_carga")
    pending = materialize(loads.join(landed, "id_carga", "left_anti"), "loads")
    opened = states.where(F.col("estado") == OPEN).select("id_carga")
    area.append(pending.join(opened, "id_carga", "left_anti").withColumns(
        {"periodo_datos": F.lit(period), "estado": F.lit(OPEN), "momento": moment}), "log_cargas")
    return pending


def _close_files(area: Area, accepted: DataFrame, moment: Column) -> None:
    """A file is processed if one of its sheets was landed."""
    done = F.col("estado") == LANDED
    per_file = area.loads().groupBy("id_archivo").agg(
        F.sum(F.when(done, F.col("leidas"))).alias("total_filas_raw"), F.sum(F.when(done, F.col("insertadas"))).alias("total_insertadas"),
        F.bool_or(done).alias("alguna_ok"))
    closed = accepted.join(per_file, "id_archivo", "left")
    state = F.when(F.col("alguna_ok"), DONE).otherwise(FAILED)
    message = F.when(F.col("alguna_ok").isNull(), F.lit(NO_SHEETS))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    area.append(closed.withColumns({
        "estado": state, "mensaje": message, "total_filas_raw": zero("total_filas_raw"),
        "total_insertadas": zero("total_insertadas"), "momento": moment}), "log_archivos")


def process_files(spark: SparkSession, folder: str, base: str, as_of: str, prepare: Callable[[DataFrame, str], DataFrame] = prepare_rows,
                  between: Callable[[str], None] = lambda kind: None) -> DataFrame:
    """Land the workbooks of ``folder`` in the area ``base``; one row with the counts of processed, duplicate and failed files.

    ``between`` is called before each kind of sheet is landed. Ids of pending loads pass through the driver, as Spark's own
    file listing does; no rows do.
    """
    area = Area(spark, base)
    moment, period = F.lit(as_of).cast("timestamp"), as_of[:7]
    every, accepted = _open_files(area, folder, moment)
    if not accepted.isEmpty():
        own_files = accepted.select(F.col("ruta_origen").alias("ruta"), "id_archivo")
        cells = scan_workbooks(spark, folder, own_files).join(own_files, "ruta").drop("ruta")
        cells = materialize(cells, "cells")
        pending = _open_loads(area, cells, accepted, period, moment)
        closing = pending.withColumns({"periodo_datos": F.lit(period), "momento": moment})
        broken = cells.where("rota").groupBy("id_archivo", "hoja").agg(F.count("*").alias("_rotas"), F.min("rescatado").alias("_primera"))
        bad = materialize(pending.join(broken, ["id_archivo", "hoja"]), "broken")
        told = F.concat(F.col("_rotas").cast("string"), F.lit(" filas ilegibles, la primera: "), F.substring("_primera", 1, 200))
        zero = {c: F.lit(0).cast("bigint") for c in COUNTERS}
        area.append(closing.join(bad.select("id_carga", told.alias("mensaje")), "id_carga").withColumns(
            {**zero, "estado": F.lit(FAILED)}), "log_cargas")
        good = materialize(closing.join(bad.select("id_carga"), "id_carga", "left_anti"), "good")
        for kind in KINDS:
            between(kind)
            of_kind = good.where(F.col("tipo") == kind)
            ids = [row[0] for row in of_kind.select("id_carga").orderBy("id_carga").collect()]
            if not ids:
                continue
            own = cells.where(~F.col("rota") & F.col("hoja").isin(aliases(kind))).join(
                of_kind.select("id_carga", "id_archivo", "hoja"), ["id_archivo", "hoja"]).drop("hoja", "rota")
            for counted, loads, message in _land_isolated(own, ids, kind, area.path(kind), prepare):
                of = of_kind.where(_among(loads))
                if counted is None:
                    area.append(of.withColumns({**zero, "estado": F.lit(FAILED), "mensaje": F.lit(message)}), "log_cargas")
                else:
                    found = of.join(counted, "id_carga", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTERS})
                    area.append(found.withColumns({"estado": F.lit(LANDED), "tanda": F.lit(batch_name(loads))}), "log_cargas")
        _close_files(area, accepted, moment)
    states = area.files().select("id_archivo", "estado")
    state = F.when(F.col("duplicado"), "Duplicado").otherwise(F.col("estado"))
    return run_summary(every.join(states, "id_archivo", "left").withColumn("estado", state))


def load_status(area: Area) -> DataFrame:
    """One row per load: its file, state and counters, and how many of its landing rows are ready or not."""
    ready = F.col("lnd_listo_para_stg")
    out = area.loads().join(area.files().select("id_archivo", "nombre_archivo"), "id_archivo")
    for kind in ("principal", "lotes"):
        counts = area.landed(kind).groupBy("id_carga").agg(
            F.count_if(ready).alias(f"{kind}_listas"), F.count_if(~ready).alias(f"{kind}_con_problemas"))
        out = out.join(counts, "id_carga", "left").fillna(0, [f"{kind}_listas", f"{kind}_con_problemas"])
    return out
