"""Shared pieces of the star schema: Spark helpers and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.catalog.inputs import COUNT_KEY, Inputs, with_inputs
from tallystock.plans import star
from tallystock.session import materialize, new_path
from tallystock.sources.tables import store_fact


def fact(t: Inputs, one_count: bool = False) -> DataFrame:
    return star.build_fact_inventory(t.count_of() if one_count else t["inv_fact"])


def discrepancy(t: Inputs, one_count: bool = False) -> DataFrame:
    return star.build_fact_discrepancy(t.count_of() if one_count else t["inv_fact"])


_stored: dict[tuple[str, str], tuple[str, str]] = {}
BUCKETS = 8


def stored_facts(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Both facts over all counts from tables of one layout; queries of one application share them."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _stored:
        counts = materialize(t["inv_fact"], "counts")
        names = []
        for label, rows in (("fact_inventario", star.build_fact_inventory(counts)), ("fact_discrepancia", star.build_fact_discrepancy(counts))):
            path = new_path(t.spark, label)
            names.append(f"{label}_{path.rsplit('-', 1)[1]}")
            store_fact(rows, names[-1], path, BUCKETS)
        _stored[key] = names[0], names[1]
    inventory, different = _stored[key]
    return t.spark.table(inventory), t.spark.table(different)


def count_facts(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Both facts of one count, from its rows stored once."""
    counts = materialize(t.count_of(), "count")
    return star.build_fact_inventory(counts), star.build_fact_discrepancy(counts)


def products(t: Inputs) -> DataFrame:
    return t["inv_dim_product"].withColumn("clasificacion_venc", star.expiry_band(F.col("dias_para_vencer")))


STATUS = """CASE WHEN cantidad_fisica > 0 AND cantidad_fisica = cantidad_sistema THEN 'DISP_OK'
     WHEN cantidad_fisica > 0 AND cantidad_fisica < cantidad_sistema THEN 'DISP_FALT'
     WHEN cantidad_fisica > 0 AND cantidad_fisica > cantidad_sistema THEN 'DISP_SOBRANTE'
     WHEN cantidad_fisica = 0 AND cantidad_sistema = 0 THEN 'SIN_STOCK'
     WHEN cantidad_fisica = 0 AND cantidad_sistema > 0 THEN 'AGOTADO_DESAC' ELSE 'PEND_REVISION' END"""
CAUSE = """CASE WHEN cantidad_fisica = cantidad_sistema THEN 'ND'
     WHEN upper(coalesce(observacion_texto, '')) LIKE '%REBAJAR%' THEN 'PR'
     WHEN upper(coalesce(observacion_texto, '')) LIKE '%ENTREGA%' THEN 'EP'
     WHEN upper(coalesce(observacion_texto, '')) LIKE '%FALTANTE%' AND cantidad_fisica < cantidad_sistema THEN 'FF'
     WHEN upper(coalesce(observacion_texto, '')) LIKE '%SOBRANTE%' AND cantidad_fisica > cantidad_sistema THEN 'SNR'
     WHEN trim(coalesce(observacion_texto, '')) <> '' AND cantidad_fisica > cantidad_sistema THEN 'SCN'
     WHEN trim(coalesce(observacion_texto, '')) <> '' THEN 'FCN'
     WHEN cantidad_fisica > cantidad_sistema THEN 'SSJ' ELSE 'FSJ' END"""
CAUSES = """causes(sk_tipo_disc, nk_tipo_disc, nombre_tipo, impacto_financiero) AS (VALUES
  (1, 'PR', 'Pendiente Rebajar', 'Alto'), (2, 'EP', 'Entrega Pendiente', 'Medio'),
  (3, 'FF', 'Faltante Físico', 'Alto'), (4, 'SNR', 'Sobrante No Registrado', 'Alto'),
  (5, 'SCN', 'Sobrante Con Nota', 'Medio'), (6, 'FCN', 'Faltante Con Nota', 'Medio'),
  (7, 'SSJ', 'Sobrante Sin Justificar', 'Bajo'), (8, 'FSJ', 'Faltante Sin Justificar', 'Bajo'),
  (9, 'ND', 'Sin Discrepancia', 'Bajo'))"""
STATES = """states(sk_estado_stock, nk_estado, nombre_estado, color_semaforo) AS (VALUES
  (1, 'DISP_OK', 'Disponible — Sin Discrepancia', 'Verde'), (2, 'DISP_FALT', 'Disponible — Faltante', 'Amarillo'),
  (3, 'DISP_SOBRANTE', 'Disponible — Sobrante', 'Amarillo'), (4, 'SIN_STOCK', 'Sin Stock', 'Gris'),
  (5, 'AGOTADO_DESAC', 'Agotado — Sistema Desactualizado', 'Rojo'),
  (6, 'PEND_REVISION', 'Pendiente de Revisión', 'Rojo'))"""
FACT_COLUMNS = f"""fi AS (SELECT * REPLACE (coalesce(sk_categoria, -1) AS sk_categoria, coalesce(sk_marca, -1) AS sk_marca), cantidad_fisica - cantidad_sistema AS diferencia_unids,
  cantidad_fisica <> cantidad_sistema AS flag_discrepancia, cantidad_fisica = 0 AS flag_stock_cero,
  {STATUS} AS nk_estado, {CAUSE} AS nk_tipo_disc FROM inv_fact)"""


def star_sql(*names: str) -> str:
    """Inputs, the fact with its derived columns (fi), stock states and discrepancy causes."""
    return f"{with_inputs('inv_fact', *names)},\n{FACT_COLUMNS},\n{CAUSES},\n{STATES}"


DAY = "CAST(make_date(sk_tiempo // 10000, 12, 31) AS VARCHAR)"
ONE_COUNT = f"sk_tiempo = {COUNT_KEY}"
BAND = """CASE WHEN dias_para_vencer IS NULL THEN 'Sin Vencimiento' WHEN dias_para_vencer < 0 THEN 'Vencido'
     WHEN dias_para_vencer <= 90 THEN 'Critico' WHEN dias_para_vencer <= 180 THEN 'Alerta'
     WHEN dias_para_vencer <= 365 THEN 'Vigilancia' ELSE 'Normal' END"""
