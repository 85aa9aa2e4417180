"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.catalog.inputs import AS_OF, Inputs, with_inputs
from tallystock.catalog.quality_sql import cell, code, date_ok, name, numeric
from tallystock.catalog.registry import query
from tallystock.catalog.star_sql import star_sql
from tallystock.functions import cells
from tallystock.functions import dates as D
from tallystock.plans.history import row_to_json

_KEYS = ["id_carga", "fila_excel"]


def _oracle(source: str, **columns: str) -> str:
    listed = ", ".join(f"{sql} AS {alias}" for alias, sql in columns.items())
    return f"{with_inputs(source)} SELECT id_carga, fila_excel, {listed} FROM {source}"


@query("clean_cell", _oracle("inv_sheet", codigo=cell("c1"), nombre=cell("c2"), observacion=cell("c6")))
def _clean_cell(t: Inputs) -> DataFrame:
    return t["inv_sheet"].select(*_KEYS, cells.clean_cell(F.col("c1")).alias("codigo"),
                                 cells.clean_cell(F.col("c2")).alias("nombre"), cells.clean_cell(F.col("c6")).alias("observacion"))


@query("clean_code", _oracle("inv_lots", lote=code("c0"), codigo=code("c1")))
def _clean_code(t: Inputs) -> DataFrame:
    return t["inv_lots"].select(*_KEYS, cells.clean_code(F.col("c0")).alias("lote"), cells.clean_code(F.col("c1")).alias("codigo"))


@query("clean_code_view", _oracle("inv_sheet", codigo="ltrim(coalesce(c1, ''), '''')"))
def _clean_code_view(t: Inputs) -> DataFrame:
    return t["inv_sheet"].select(*_KEYS, cells.clean_code_view(F.col("c1")).alias("codigo"))


@query("clean_name", _oracle("inv_lots", nombre=name("c2")))
def _clean_name(t: Inputs) -> DataFrame:
    return t["inv_lots"].select(*_KEYS, cells.clean_name(F.col("c2")).alias("nombre"))


@query("is_numeric", _oracle("inv_kardex", costo=numeric("c4"), entradas=numeric("c5"), precio=numeric("c6"),
                             salidas=numeric("c7"), toma=numeric("c9")))
def _is_numeric(t: Inputs) -> DataFrame:
    names = {"costo": "c4", "entradas": "c5", "precio": "c6", "salidas": "c7", "toma": "c9"}
    return t["inv_kardex"].select(*_KEYS, *[cells.is_numeric(F.col(c)).alias(n) for n, c in names.items()])


@query("is_date_parseable", _oracle("inv_kardex", fecha="c1", parseable=date_ok("c1")))
def _is_date(t: Inputs) -> DataFrame:
    return t["inv_kardex"].select(*_KEYS, F.col("c1").alias("fecha"), cells.is_date_parseable(F.col("c1")).alias("parseable"))


@query("normalize_lot_state", _oracle("inv_lots", estado=f"""CASE WHEN c3 IN ('N/A', 'NA', '') THEN NULL
  WHEN {numeric('c3')} THEN CAST(CAST(trunc(CAST(replace(c3, ',', '') AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE c3 END"""))
def _lot_state(t: Inputs) -> DataFrame:
    return t["inv_lots"].select(*_KEYS, cells.normalize_lot_state(F.col("c3")).alias("estado"))


@query("null_tokens", _oracle("inv_lots", vencimiento="CASE WHEN c8 NOT IN ('N/A', 'NA', '') THEN c8 END"))
def _null_tokens(t: Inputs) -> DataFrame:
    return t["inv_lots"].select(*_KEYS, cells.null_tokens(F.col("c8")).alias("vencimiento"))


_NUMBER = "CAST(TRY_CAST(replace({0}, ',', '') AS DECIMAL(12,2)) AS DOUBLE)"


@query("text_to_number", _oracle("inv_sheet", fisico_raw="c3", fisico=_NUMBER.format("c3"), sistema=_NUMBER.format("c4")))
def _to_number(t: Inputs) -> DataFrame:
    return t["inv_sheet"].select(*_KEYS, F.col("c3").alias("fisico_raw"), cells.text_to_number(F.col("c3")).alias("fisico"),
                                 cells.text_to_number(F.col("c4")).alias("sistema"))


@query("text_to_date", _oracle("inv_kardex", fecha_raw="c1",
                               fecha="CAST(CAST(try_strptime(c1, '%d/%m/%Y') AS DATE) AS VARCHAR)"))
def _to_date(t: Inputs) -> DataFrame:
    return t["inv_kardex"].select(*_KEYS, F.col("c1").alias("fecha_raw"), cells.text_to_date(F.col("c1")).alias("fecha"))


@query("zero_fill", _oracle("inv_sheet", fisico=f"coalesce({_NUMBER.format('c3')}, 0)", sistema=f"coalesce({_NUMBER.format('c4')}, 0)"))
def _zero_fill(t: Inputs) -> DataFrame:
    filled = [cells.zero_fill(cells.text_to_number(F.col(c))).alias(n) for n, c in {"fisico": "c3", "sistema": "c4"}.items()]
    return t["inv_sheet"].select(*_KEYS, *filled)


@query("upper_trim_contains_startswith", f"""{with_inputs('inv_product')}
SELECT id_producto, upper(trim(nombre)) AS nombre, coalesce(contains(upper(nombre), 'YARA'), false) AS yara,
       coalesce(starts_with(upper(codigo_producto), 'ABP'), false) AS abp FROM inv_product""")
def _tests(t: Inputs) -> DataFrame:
    text = F.upper(cells.strip(F.col("nombre")))
    return t["inv_product"].select(
        "id_producto", text.alias("nombre"), F.coalesce(F.contains(text, F.lit("YARA")), F.lit(False)).alias("yara"),
        F.coalesce(F.startswith(F.upper("codigo_producto"), F.lit("ABP")), F.lit(False)).alias("abp"))


@query("regex_match_extract", rf"""{with_inputs('inv_product')}
SELECT id_producto, regexp_matches(upper(nombre), '\d+([.,]\d+)?M') AS mide,
       nullif(regexp_extract(upper(nombre), 'CJ\d+'), '') AS caja,
       nullif(regexp_extract(upper(nombre), '\d+([.,]\d+)?\s*(KG|KGS|LT|LTS|G|GRAMOS|LB)'), '') AS peso FROM inv_product""")
def _regex(t: Inputs) -> DataFrame:
    box, weight, length = V.PRESENTATION_PATTERNS
    text = F.upper("nombre")
    return t["inv_product"].select(
        "id_producto", F.regexp_like(text, F.lit(length)).alias("mide"), F.regexp_substr(text, F.lit(box)).alias("caja"),
        F.regexp_substr(text, F.lit(weight)).alias("peso"))


@query("abs_round_nullif_coalesce", f"""{star_sql()}
SELECT sk_tiempo, sk_producto, CAST(abs(diferencia_unids) AS DOUBLE) AS magnitud,
       (CAST((CAST(abs(diferencia_unids) * 100 AS HUGEINT) * 20 + CAST(cantidad_sistema * 100 AS HUGEINT))
         // nullif(2 * CAST(cantidad_sistema * 100 AS HUGEINT), 0) AS DOUBLE) / 10) AS veces,
       coalesce(observacion_texto, 'sin nota') AS nota FROM fi""")
def _helpers(t: Inputs) -> DataFrame:
    gap = F.abs(F.col("cantidad_fisica") - F.col("cantidad_sistema"))
    times = F.round(gap.cast("decimal(20,2)") / F.nullif("cantidad_sistema", F.lit(0).cast("decimal(12,2)")), 1)
    return t["inv_fact"].select("sk_tiempo", "sk_producto", gap.alias("magnitud"), times.alias("veces"),
                                F.coalesce("observacion_texto", F.lit("sin nota")).alias("nota"))


_MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
_DAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"
_ORDER_DAYS = "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS pedidos FROM orders GROUP BY 1)"


def _order_days(t: Inputs) -> DataFrame:
    return t.table("orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("pedidos"))


@query("date_parts", f"""{_ORDER_DAYS}
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS sk_tiempo, strftime(d, '%Y') AS nombre_anio, strftime(d, '%Y-%m') AS anio_mes,
       strftime(d, '%m-%d') AS mes_dia, CAST(year(d) AS INT) AS anio, CAST(quarter(d) AS INT) AS trimestre,
       CAST(month(d) AS INT) AS mes, CAST(week(d) AS INT) AS semana_anio, CAST(day(d) AS INT) AS dia_mes,
       CAST(isodow(d) AS INT) AS dia_semana, pedidos FROM o""")
def _date_parts(t: Inputs) -> DataFrame:
    d = F.col("d")
    parts = D.calendar_columns(d)
    names = ["sk_tiempo", "nombre_anio", "anio_mes", "anio", "trimestre", "mes", "semana_anio", "dia_mes", "dia_semana"]
    return _order_days(t).select(*[parts[n].alias(n) for n in names], F.date_format(d, "MM-dd").alias("mes_dia"), "pedidos")


@query("case_names", f"""{_ORDER_DAYS}
SELECT CAST(d AS VARCHAR) AS fecha, {_MONTHS}[month(d)] AS nombre_mes, {_DAYS}[isodow(d)] AS nombre_dia,
       CASE strftime(d, '%m-%d') WHEN '01-01' THEN 'Año Nuevo' WHEN '04-11' THEN 'Día de Juan Santamaría'
         WHEN '05-01' THEN 'Día del Trabajo' WHEN '07-25' THEN 'Anexión del Partido de Nicoya'
         WHEN '08-02' THEN 'Virgen de los Ángeles' WHEN '08-15' THEN 'Día de la Madre'
         WHEN '09-15' THEN 'Día de la Independencia' WHEN '10-12' THEN 'Día de las Culturas'
         WHEN '12-25' THEN 'Navidad' END AS nombre_feriado FROM o""")
def _case_names(t: Inputs) -> DataFrame:
    parts = D.calendar_columns(F.col("d"))
    return _order_days(t).select(F.col("d").alias("fecha"), *[parts[n].alias(n) for n in ["nombre_mes", "nombre_dia", "nombre_feriado"]])


@query("concat_lpad", f"""{_ORDER_DAYS}
SELECT CAST(d AS VARCHAR) AS fecha, 'Q' || quarter(d) || '-' || year(d) AS nombre_trimestre,
       'S' || lpad(CAST(week(d) AS VARCHAR), 2, '0') || '-' || year(d) AS nombre_semana FROM o""")
def _labels(t: Inputs) -> DataFrame:
    d = F.col("d")
    return _order_days(t).select(d.alias("fecha"), D.quarter_label(d).alias("nombre_trimestre"), D.week_label(d).alias("nombre_semana"))


@query("date_diff_days", f"""{with_inputs('inv_product')}
SELECT id_producto, CAST(fecha_vencimiento - DATE '{AS_OF}' AS INT) AS dias_para_vencer FROM inv_product""")
def _diff(t: Inputs) -> DataFrame:
    return t["inv_product"].select("id_producto", D.days_between(F.col("fecha_vencimiento"), F.lit(AS_OF).cast("date")).alias("dias_para_vencer"))


@query("epoch_duration", """
SELECT user_id, CAST(CAST((epoch_us(max(ts)) - epoch_us(min(ts)) + 500) // 1000 AS BIGINT) AS DOUBLE) / 1000 AS duracion_seg
FROM events GROUP BY user_id""")
def _duration(t: Inputs) -> DataFrame:
    return t.table("events").groupBy("user_id").agg(D.epoch_duration(F.min("ts"), F.max("ts")).alias("duracion_seg"))


@query("days_to_months", f"""{with_inputs('inv_dim_product')}
SELECT sk_producto, CAST((dias_para_vencer * 20 + 30) // 60 AS DOUBLE) / 10 AS meses FROM inv_dim_product WHERE dias_para_vencer >= 0""")
def _months(t: Inputs) -> DataFrame:
    return t["inv_dim_product"].where("dias_para_vencer >= 0").select("sk_producto", D.days_to_months(F.col("dias_para_vencer")).alias("meses"))


@query("row_to_json", f"""{with_inputs('inv_product_v2')}
SELECT CAST(id AS VARCHAR) AS id_registro, nombre, presentacion, CAST(fecha_vencimiento AS VARCHAR) AS fecha_vencimiento FROM inv_product_v2""")
def _json(t: Inputs) -> DataFrame:
    rows = t["inv_product_v2"]
    image = rows.select(row_to_json(rows.columns).alias("imagen"))
    fields = {"id_registro": "id", "nombre": "nombre", "presentacion": "presentacion", "fecha_vencimiento": "fecha_vencimiento"}
    return image.select(*[F.get_json_object("imagen", f"$.{f}").alias(n) for n, f in fields.items()])
