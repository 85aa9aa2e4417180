"""Versioned dimensions, change journal, incremental loads and process logs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions.dates import days_between, epoch_duration
from tallystock.operators.windows import first_per_key, number_rows
from tallystock.plans.star import expiry_band
from tallystock.session import materialize

VERSIONED = ["nombre", "presentacion", "fecha_vencimiento"]


def first_versions(products: DataFrame, as_of: str) -> DataFrame:
    """A dimension with one open version per product; surrogate key = natural key."""
    return products.select(
        F.col("id").alias("sk_producto"), "id", *VERSIONED,
        F.lit(as_of).cast("date").alias("fecha_inicio_vigencia"),
        F.lit(V.OPEN_END).cast("date").alias("fecha_fin_vigencia"),
        F.lit(True).alias("es_registro_activo"))


def compare(dimension: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Full outer comparison of open versions with incoming rows, with ``cambio`` set to
    new, changed, same or absent. Of incoming rows that repeat a key the first in order of
    the versioned columns counts, so both sides have one row per key and no key is hot."""
    old = dimension.where("es_registro_activo").alias("o")
    new = first_per_key(incoming, [key], [F.col(c) for c in VERSIONED]).alias("n")
    same = F.lit(True)
    for c in VERSIONED:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    change = (F.when(F.col(f"o.{key}").isNull(), "new").when(F.col(f"n.{key}").isNull(), "absent")
              .when(same, "same").otherwise("changed"))
    return old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").withColumn("cambio", change)


def scd2_merge(dimension: DataFrame, incoming: DataFrame, as_of: str, key: str = "id") -> DataFrame:
    """Close changed versions the day before ``as_of``, open new ones, keep the rest.

    A product that is absent from the input keeps its open version. New surrogate keys go
    on from the highest one, in key order.
    """
    day = F.lit(as_of).cast("date")
    # Stored, so that the rows that stay and those that open come from one comparison.
    both = compare(dimension, incoming, key)
    compared = materialize(both.select("cambio", F.struct("o.*").alias("o"), F.struct("n.*").alias("n")), "compared")
    names = ["sk_producto", key, *VERSIONED, "fecha_inicio_vigencia", "fecha_fin_vigencia", "es_registro_activo"]
    closing = F.col("cambio") == "changed"
    kept = compared.where(F.col("cambio") != "new").select(
        "o.sk_producto", f"o.{key}", *[F.col(f"o.{c}") for c in VERSIONED], "o.fecha_inicio_vigencia",
        F.when(closing, F.date_sub(day, 1)).otherwise(F.col("o.fecha_fin_vigencia")).alias("fecha_fin_vigencia"),
        (~closing).alias("es_registro_activo"))
    opened = compared.where(F.col("cambio").isin("new", "changed")).select(
        f"n.{key}", *[F.col(f"n.{c}") for c in VERSIONED], day.alias("fecha_inicio_vigencia"),
        F.lit(V.OPEN_END).cast("date").alias("fecha_fin_vigencia"), F.lit(True).alias("es_registro_activo"))
    highest = dimension.agg(F.coalesce(F.max("sk_producto"), F.lit(0)).alias("m")).scalar()
    numbered = number_rows(opened, [F.col(key)], "_n")
    fresh = numbered.withColumn("sk_producto", highest + F.col("_n")).select(*names)
    history = dimension.where(~F.col("es_registro_activo")).select(*names)
    return kept.select(*names).unionByName(fresh).unionByName(history)


def overwrite_expiry(dimension: DataFrame, as_of: str) -> DataFrame:
    """Days to expiry and band, overwritten in place on every load."""
    days = days_between(F.col("fecha_vencimiento"), F.lit(as_of).cast("date"))
    return dimension.withColumns({"dias_para_vencer": days, "clasificacion_venc": expiry_band(days)})


def row_to_json(columns: list[str], prefix: str = "") -> Column:
    """Row image; nulls are kept as null members."""
    return F.to_json(F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def change_journal(before: DataFrame, after: DataFrame, table: str, key: str = "id") -> DataFrame:
    """INSERT, UPDATE and DELETE images between two states of a table; equal rows give none."""
    names = before.columns
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    operation = (F.when(F.col(f"b.{key}").isNull(), "INSERT").when(F.col(f"a.{key}").isNull(), "DELETE")
                 .when(~same, "UPDATE"))
    both = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer").withColumn("operacion", operation)
    return both.where(F.col("operacion").isNotNull()).select(
        F.lit(table).alias("tabla"), "operacion",
        F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).cast("string").alias("id_registro"),
        F.when(F.col("operacion") != "INSERT", row_to_json(names, "b.")).alias("valores_antes"),
        F.when(F.col("operacion") != "DELETE", row_to_json(names, "a.")).alias("valores_despues"))


def stamp_modified(before: DataFrame, after: DataFrame, stamp: str, as_of: str, key: str = "id") -> DataFrame:
    """``after`` with the last-modified stamp: as_of on rows that differ, the stored one otherwise."""
    names = [c for c in after.columns if c != stamp]
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    moved = F.lit(as_of).cast("date")
    value = F.when(F.col(f"b.{key}").isNotNull() & ~same, moved).otherwise(F.coalesce(F.col(f"b.{stamp}"), moved))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "left").select(
        *[F.col(f"a.{c}") for c in names], value.alias(stamp))


def last_mark(control: DataFrame, process: str) -> DataFrame:
    """One row: date of the newest data a process has loaded, null if it never ran."""
    done = (F.col("nombre_proceso") == process) & (F.col("estado_ultimo") == "Completado")
    return control.where(done).agg(F.max("ultima_fecha_dato").alias("marca"))


def incremental_rows(rows: DataFrame, date: str, control: DataFrame, process: str) -> DataFrame:
    """Rows of a later day than the last good load. ``date`` may be a date or a timestamp.

    The mark is read first: as a constant against the bare column, it reaches the scan.
    """
    mark = last_mark(control, process).first().marca
    if mark is None:
        return rows
    return rows.where(F.col(date) >= F.lit(mark + timedelta(days=1)).cast(rows.schema[date].dataType))


def move_mark(control: DataFrame, rows: DataFrame, date: str, process: str) -> DataFrame:
    """Control table after a good load of ``rows``: their newest date becomes the mark (none
    new keeps it) and the counter of the process goes up. Call it after the load is stored: a load that is killed before leaves
    the mark, and is run again from there."""
    newest = rows.agg(F.max(date).alias("m")).scalar()
    mine = F.col("nombre_proceso") == process
    moved = control.withColumns({
        "ultima_fecha_dato": F.when(mine, F.coalesce(newest, "ultima_fecha_dato")).otherwise(F.col("ultima_fecha_dato")),
        "total_cargas": F.col("total_cargas") + F.when(mine, 1).otherwise(0),
        "estado_ultimo": F.when(mine, F.lit("Completado")).otherwise(F.col("estado_ultimo")),
    })
    return moved


def process_log(outcome: DataFrame, process: str, table: str, start: Column, end: Column) -> DataFrame:
    """Inserted, updated, deleted and rejected row counts of a load in one row.

    ``outcome`` has ``cambio`` (new, changed, same, absent) and ``rechazada`` per row.
    """
    ok = ~F.col("rechazada")
    counted = outcome.agg(
        F.count_if(ok & F.col("cambio").isin("new", "changed")).alias("filas_insertadas"),
        F.count_if(ok & (F.col("cambio") == "changed")).alias("filas_actualizadas"),
        F.count_if(ok & (F.col("cambio") == "absent")).alias("filas_eliminadas"),
        F.count_if(F.col("rechazada")).alias("filas_rechazadas"),
        epoch_duration(F.min(start), F.max(end)).alias("duracion_seg"),
    )
    return counted.select(
        F.lit(process).alias("proceso"), F.lit(table).alias("tabla_afectada"), "*",
        F.when(F.col("filas_rechazadas") > 0, "Advertencia").otherwise("Completado").alias("estado"))


def latest_marks(marks: DataFrame) -> DataFrame:
    """Current control row per process from appended ones."""
    return first_per_key(marks, ["nombre_proceso"], [F.col("total_cargas").desc()])
