"""Sheets from text files to landing rows, warnings and staging."""

import pytest
from pyspark.sql import functions as F

from tallystock.operators.aggregates import coverage_gate
from tallystock.operators.filters import row_kind
from tallystock.plans import quality as Q
from tallystock.sources import files, sheets

MAIN = [
    "1,,TITULO", "4,,'9,Antes de sección,1,1,0", "5,, Líquidos ", "6,,Código,Nombre,Fisico,Sist",
    '7,,\'4000100372 , Nitro  X ,"1,234.56",1234.56,0,nota', "8,,,,,", "9,,Semillas", "10,,granular-solubles",
    "11,,,Sin codigo,5,,0", "12,,77,,-3,2,-5", "13,,78,Dos,-,2,0",
]


@pytest.fixture
def sheet(spark, tmp_path):
    (tmp_path / "hoja.csv").write_text("\n".join(MAIN), encoding="utf-8")
    return sheets.scan_sheet(spark, str(tmp_path / "hoja.csv"), "principal").withColumn("id_carga", F.lit(1))


def test_scan_drops_rows_above_the_data(sheet):
    assert sorted(r.fila_excel for r in sheet.collect()) == list(range(4, 14))
    assert {r.archivo for r in sheet.collect()} == {"hoja.csv"}


def test_row_kinds(sheet):
    kinds = {r.fila_excel: r.k for r in sheet.select("fila_excel", row_kind("principal").alias("k")).collect()}
    assert kinds == {4: "dato", 5: "seccion", 6: "encabezado", 7: "dato", 8: "vacia", 9: "dato", 10: "seccion",
                     11: "dato", 12: "dato", 13: "dato"}


def test_landing(sheet):
    landed = {r.fila_excel: r for r in Q.land(sheet, "principal").collect()}
    assert [landed[i].categoria_raw for i in (4, 7, 9, 11)] == [None, "Liquidos", "Liquidos", "Granular - Solubles"]
    assert landed[7].lnd_listo_para_stg and landed[7].codigo_raw == "'4000100372"
    assert not landed[9].lnd_tiene_nombre and not landed[11].lnd_listo_para_stg
    assert not landed[13].lnd_fisico_numerico and not landed[13].es_fila_seccion


def test_warnings(sheet):
    got = Q.warnings(Q.land(sheet, "principal"), "principal", ["fila_excel"]).collect()
    assert sorted((r.fila_excel, r.regla_violada) for r in got) == [
        (9, "RV-02"), (11, "RV-01"), (11, "RV-04"), (12, "RV-02")]


def test_staging_and_rule_codes(rows, sheet):
    loads = rows([(1, "2026-05")], "id_carga int, periodo_datos string")
    ready = Q.ready_rows(Q.land(sheet, "principal"), loads, "principal")
    row = {r.fila_excel: r for r in ready.collect()}[7]
    assert (row.codigo_limpio, row.nombre_limpio, row.periodo_datos) == ("4000100372", "Nitro  X", "2026-05")


def test_rule_code_order(rows):
    data = [("", "n", -1, 1, 0), ("c", None, -1, 1, 0), ("c", "", 1, 1, 0), ("c", "n", 1, None, 0), ("c", "n", 3, 1, 0),
            ("c", "n", 3, 1, 2), ("c", "n", 3, 1, None), ("c", "n", None, 1, 5)]
    df = rows([(a, b, *map(lambda x: None if x is None else float(x), r)) for a, b, *r in data],
              "c string, n string, f double, s double, d double")
    q = [F.col(x).cast("decimal(12,2)") for x in "fsd"]
    got = [r[0] for r in df.select(Q.rule_code(F.col("c"), F.col("n"), *q)).collect()]
    assert got == ["ERROR RV-01", "ERROR RV-03:", "WARNING RV-02", "WARNING RV-04", "WARNING RV-05", "OK", "OK", "OK"]


def test_coverage(sheet):
    row = coverage_gate(sheet, "id_carga").collect()[0]
    assert (row.total, row.con_codigo, float(row.pct_codigo), row.estado) == (6, 5, 83.33, "OK")


def test_movement_without_date_is_ready(rows):
    data = [("Toma Física", None), ("Entrada", "2001/01/01"), ("Ajuste", "1/1/2001"), ("tipo", "fecha"), (None, None)]
    df = rows([(1, i, t, f, None, None, None) for i, (t, f) in enumerate(data)],
              "id_carga int, fila_excel int, tipo_raw string, fecha_raw string, documento_raw string, entradas_raw string, salidas_raw string")
    landed = Q.land(df, "movimientos")
    assert {r.fila_excel: r.lnd_listo_para_stg for r in landed.collect()} == {0: True, 1: False, 2: False}
    assert sorted(r.regla_violada for r in Q.warnings(landed, "movimientos", ["fila_excel"]).collect()) == ["FECHA", "RV-14"]


def test_price_warning(rows):
    df = rows([(1, str(i), "d", p, None) for i, p in enumerate(["0", None, "0.00", "5", "USD"])],
              "id_carga int, codigo_raw string, descripcion_raw string, precio1_raw string, existencia_raw string")
    got = Q.warnings(Q.land(df, "catalogo"), "catalogo", ["codigo_raw"]).collect()
    assert sorted(r.codigo_raw for r in got) == ["0", "1"]


def test_discover_files(spark, tmp_path):
    for name in ["b.xlsx", "a.xlsx", "~$a.xlsx", "c.csv"]:
        (tmp_path / name).write_bytes(b"same" if name != "b.xlsx" else b"other")
    found = files.discover_files(spark, str(tmp_path)).collect()
    assert [r.nombre_archivo for r in found] == ["a.xlsx", "b.xlsx"]
    assert [r.tamanio_bytes for r in found] == [4, 5]


def test_dedupe_files(rows):
    arrived = rows([(1, "x"), (2, "x"), (3, "y"), (4, "z")], "id int, hash_md5 string")
    log = rows([("y", "Procesado"), ("z", "Error")], "hash_md5 string, estado string")
    accepted = files.dedupe_files_md5(arrived, log, "id")
    assert sorted(r.id for r in accepted.collect()) == [1, 4]
    marked = files.mark_files(arrived, accepted, "id")
    assert sorted(r.id for r in marked.where("duplicado").collect()) == [2, 3]


def test_route_sheets(rows):
    books = rows([(1, "Manvert Jiffy"), (1, "Manvert,Jiffy"), (1, "Otra"), (2, "Otra")], "id_archivo int, hoja string")
    fate = {(r.id_archivo, r.hoja): r.destino for r in sheets.route_sheets(books).collect()}
    assert fate == {(1, "Manvert Jiffy"): "repetida", (1, "Manvert,Jiffy"): "procesar", (1, "Otra"): "desconocida",
                    (2, "Otra"): "desconocida"}
    assert sheets.missing_sheets(books).where("id_archivo = 2").count() == 6


def test_failed_kind_is_logged(rows, sheet, tmp_path):
    ok = Q.load_sheet(sheet, "principal", str(tmp_path / "ok"), ["id_carga"]).first()
    assert (ok.estado, ok.leidas, ok.insertadas, ok.secciones, ok.warnings) == ("Completado", 10, 6, 2, 4)
    again = Q.load_sheet(sheet, "principal", str(tmp_path / "ok"), ["id_carga"]).first()
    assert again == ok and sheet.sparkSession.read.parquet(str(tmp_path / "ok")).count() == ok.insertadas
    bad = Q.load_sheet(sheet.drop("nombre_raw"), "principal", str(tmp_path / "bad"), ["id_carga"]).first()
    assert bad.estado == "Error" and bad.leidas == 0 and bad.mensaje_error
