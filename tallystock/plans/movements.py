"""Inflows and outflows, and the ageing light built on the last inflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions.cells import text_to_date, text_to_number
from tallystock.functions.dates import days_between
from tallystock.operators.filters import keep_values, remove_values
from tallystock.operators.lookups import lookup_inner, lookup_or_null

INFLOW_TYPE = 1


def dated_headers(headers: DataFrame) -> DataFrame:
    return headers.withColumns({"fecha_raw": F.col("fecha"), "fecha": text_to_date(F.col("fecha"))})


def header_detail_join(lines: DataFrame, headers: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Inflow lines with the date of their header; lines without a header keep a null date."""
    return lookup_or_null(lines, "id_entrada", headers, "codigo", {"fecha": "fecha"}, order)


def inflows(lines: DataFrame, headers: DataFrame) -> DataFrame:
    return header_detail_join(lines, dated_headers(headers)).withColumn("id_tipo_mov", F.lit(INFLOW_TYPE))


def outflows(lines: DataFrame) -> DataFrame:
    """A positive quantity on an outflow row is type 1, any other type 2."""
    return lines.withColumns({
        "fecha_raw": F.col("fecha"),
        "fecha": text_to_date(F.col("fecha")),
        "id_tipo_mov": F.when(F.col("cantidad") > 0, INFLOW_TYPE).otherwise(2),
    })


def append_two_flows(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def movement_rows(flow: DataFrame, code: str, products: DataFrame) -> DataFrame:
    """Rows whose code is in the product master, in the shape of the movement table."""
    matched = lookup_inner(flow, code, products, "codigo_producto", {"id_producto": "id_producto"})
    return matched.select("id_producto", "id_tipo_mov", F.col("fecha").alias("fecha_movimiento"), "cantidad")


def build_movements(inflow: DataFrame, headers: DataFrame, outflow: DataFrame, products: DataFrame) -> DataFrame:
    """Inflows match by product code, outflows by serial; both are appended.

    Both flows are brought to one shape first, so the product master is shuffled once.
    """
    columns = ["_code", "id_tipo_mov", "fecha", "cantidad"]
    both = append_two_flows(
        inflows(inflow, headers).withColumn("_code", F.col("codigo")).select(columns),
        outflows(outflow).withColumn("_code", F.col("serie")).select(columns),
    )
    return movement_rows(both, "_code", products)


def real_inflows(movements: DataFrame) -> DataFrame:
    """Inflows without the noise quantities."""
    return remove_values(keep_values(movements, "id_tipo_mov", [INFLOW_TYPE]), "cantidad",
                         [F.lit(q).cast("decimal(12,2)") for q in V.NOISE_QUANTITIES])


def last_inflow(movements: DataFrame) -> DataFrame:
    """Date of the last real inflow per product; only the date is needed, so a plain max does."""
    return real_inflows(movements).groupBy("id_producto").agg(F.max("fecha_movimiento").alias("ultima_modificacion"))


def light_columns(last: Column, cut_date: str) -> dict[str, Column]:
    """Days since the last inflow and the light; a date after the cut is green."""
    days = days_between(F.lit(cut_date).cast("date"), last)

    def pick(position: int) -> Column:
        green, yellow, red, review = [F.lit(light[position]) for light in V.LIGHTS]
        return (F.when(last.isNull(), review).when(days <= V.GREEN_DAYS, green)
                .when(days <= V.YELLOW_DAYS, yellow).otherwise(red))

    return {"dias_inventariado": days, "color_semaforo": pick(1), "id_semaforo": pick(0)}


# Staging column -> control column, one row per product of the count.
CONTROL = {"id_stg_inv": "id_producto", "codigo_raw": "codigo_producto", "nombre_raw": "nombre"}


def control_rows(staging: DataFrame) -> DataFrame:
    """Control rows of the ageing light: typed quantities next to the product they belong to."""
    quantities = [text_to_number(F.col(f"{q}_raw")).alias(q) for q in ["fisico", "sistema", "diferencia"]]
    return staging.select(*[F.col(s).alias(t) for s, t in CONTROL.items()], *quantities)


def ageing_light(control: DataFrame, movements: DataFrame, cut_date: str,
                 products: DataFrame | None = None) -> DataFrame:
    """Control rows (one per product) with their last inflow, days and light, and the brand
    and category ids of the product where the product master is given."""
    rest = control.drop("color_semaforo")  # the incoming one is replaced by the derived one
    dated = lookup_or_null(rest, "id_producto", last_inflow(movements), "id_producto",
                           {"ultima_modificacion": "ultima_modificacion"}, unique=True)
    lit = dated.withColumns(light_columns(F.col("ultima_modificacion"), cut_date))
    if products is None:
        return lit
    return lookup_or_null(lit, "id_producto", products, "id_producto", {"id_marca": "id_marca", "id_categoria": "id_categoria"})
