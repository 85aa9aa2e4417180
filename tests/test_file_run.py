"""Workbooks from text files to landing rows: scanner, run, resumption, failures."""

import pytest
from pyspark.sql import functions as F

from tallystock.plans import file_run as R
from tallystock.sources import files, sheets

MAIN = ["Fertilisa,1,,TITULO", "Fertilisa,4,, Líquidos", "Fertilisa,5,,Código,Nombre", "Fertilisa,6,,'77,Uno,\"1,5\",2,0,x", "Fertilisa,7,,,,,",
        "Fertilisa,8,,78,,-,2,0", "Fertilisa,9,,,Sin codigo,3"]
LOTS = ['"Manvert, Jiffy",4,L1,80,Lote,569.0,1,2,0,,2026-08-15T00:00:00,#REF!,,365', '"Manvert, Jiffy",5,L2,81,Otro,N/A,1,2,0,,2026/08/15,a,b,12,sobra,"y, más"']
CATALOGUE = ["LISTA DE PRODUCTOS,2,77,Uno,0", "LISTA DE PRODUCTOS,3,78,Dos,5.5,,,3"]
KARDEX = ["EJEMPLO DATOS KARDEX,2,Toma Física,15/8/2026,'9", "EJEMPLO DATOS KARDEX,3,Ajuste,,"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()

    def write(**books):
        for name, lines in books.items():
            (tmp_path / "in" / f"{name}.xlsx").write_text("\n".join(lines), encoding="utf-8")
        return str(tmp_path / "in")
    return write


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "area")


def run(spark, folder, base, **how):
    return tuple(R.process_files(spark, folder, base, "2026-05-08 10:00:00", **how).first())


def picture(area):
    """Everything a reader sees: file and load states, landed rows."""
    states = [tuple(x) for x in area.files().drop("momento").orderBy("id_archivo").collect()]
    loads = [tuple(x) for x in area.loads().drop("momento").orderBy("id_carga").collect()]
    rows = {}
    for kind in R.KINDS:
        try:
            landed = area.landed(kind)
        except Exception:  # noqa: BLE001  nothing of this kind was landed yet
            continue
        rows[kind] = sorted(map(str, landed.select(*sorted(landed.columns)).collect()))
    return states, loads, rows


def test_scanner_reads_quotes_short_long_and_broken_lines(spark, folder):
    lines = ['H,4,"a, ""b""",x', 'H,5,1,2,3,4,5,6,7,8,9,10,11,12,13,"1,4"', 'H,x,1', 'H,7,"sin cierre', 'H,8,5" tubo,', "H,9", '"H"x,1', "",
             "H,10,2026-08-15T00:00:00,2026-02-30T00:00:00,2026-08-15,2026-08-15T10:11:12.5"]
    rows = {x.fila_excel: x for x in sheets.scan_workbooks(spark, folder(a=lines)).where("not rota").collect()}
    assert rows[4].celdas == ['a, "b"', "x"] and rows[4].hoja == "H" and rows[4].rescatado is None
    assert rows[5].celdas == [str(k) for k in range(1, 13)] and rows[5].rescatado == "13,1,4"
    assert rows[8].celdas == ['5" tubo', ""] and rows[9].celdas == []
    assert rows[10].celdas == ["2026-08-15", "2026-02-30T00:00:00", "2026-08-15", "2026-08-15"]
    broken = sheets.scan_workbooks(spark, folder(a=lines)).where("rota").collect()
    assert sorted(x.rescatado for x in broken) == ["", '"H"x,1', 'H,7,"sin cierre', "H,x,1"]
    assert all(x.fila_excel is None for x in broken)


def test_all_kinds_are_landed_and_counted(spark, folder, base):
    assert run(spark, folder(a=MAIN + LOTS + CATALOGUE + KARDEX + ["Hoja1,1,x"]), base) == (1, 0, 0)
    area = R.Area(spark, base)
    loads = {x.tipo: x for x in area.loads().collect()}
    counters = {k: tuple(x[c] for c in R.COUNTERS) for k, x in loads.items()}
    assert counters == {"principal": (6, 1, 1, 1, 3, 3), "lotes": (2, 0, 0, 0, 2, 1), "catalogo": (2, 0, 0, 0, 2, 1),
                        "movimientos": (2, 0, 0, 0, 2, 1)}
    assert {x.estado for x in loads.values()} == {"Completado"} and {x.periodo_datos for x in loads.values()} == {"2026-05"}
    main = {x.fila_excel: x for x in area.landed("principal").collect()}
    assert sorted(main) == [6, 8, 9] and {x.categoria_raw for x in main.values()} == {"Liquidos"}
    assert main[6].lnd_listo_para_stg and main[6].fisico_raw == "1,5" and not main[8].lnd_listo_para_stg
    lots = {x.lote_raw: x for x in area.landed("lotes").collect()}
    assert lots["L1"].fecha_venc_raw == "2026-08-15" and lots["L1"].estado_lote_raw == "569" and lots["L1"].almacenaje_raw == "365"
    assert lots["L2"].rescatado == "sobra,y, más"
    file = area.files().first()
    assert (file.estado, file.total_filas_raw, file.total_insertadas, file.mensaje) == ("Procesado", 12, 9, None)
    status = R.load_status(area).where("tipo = 'principal'").first()
    assert (status.principal_listas, status.principal_con_problemas, status.lotes_listas) == (1, 2, 0)


@pytest.mark.parametrize("kill_before", R.KINDS)
def test_killed_run_continues_to_the_same_result(spark, folder, tmp_path, kill_before):
    path = folder(a=MAIN + LOTS + CATALOGUE + KARDEX, b=MAIN[:4] + KARDEX, copia=MAIN[:4] + KARDEX, c=["Otra,1,x"])
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    assert run(spark, path, whole) == (2, 1, 1)

    def kill(kind):
        if kind == kill_before:
            raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        run(spark, path, cut, between=kill)
    half = R.Area(spark, cut)
    assert {x.estado for x in half.files().collect()} == {"En Proceso"}
    done = R.KINDS[:R.KINDS.index(kill_before)]
    assert {x.tipo for x in half.loads().where("estado = 'Completado'").collect()} == set(done)
    assert run(spark, path, cut) == (2, 1, 1)
    assert picture(R.Area(spark, cut)) == picture(R.Area(spark, whole))
    assert half.load_events().groupBy("id_carga").count().where("count <> 2").count() == 0


def test_rows_of_an_attempt_that_did_not_close_are_not_seen(spark, folder, base, monkeypatch):
    path = folder(a=CATALOGUE)
    append = R.Area.append

    def lost(self, events, log):
        if log == "log_cargas" and events.where("estado = 'Completado'").count():
            raise KeyboardInterrupt
        append(self, events, log)
    monkeypatch.setattr(R.Area, "append", lost)
    with pytest.raises(KeyboardInterrupt):
        run(spark, path, base)
    area = R.Area(spark, base)
    assert spark.read.parquet(area.path("catalogo")).count() == 2 and area.landed("catalogo").count() == 0
    monkeypatch.undo()
    assert run(spark, path, base) == (1, 0, 0) and area.landed("catalogo").count() == 2


def test_processed_files_are_skipped_and_failed_ones_tried_again(spark, folder, base):
    path = folder(a=MAIN, b=["Otra,1,x"])
    assert run(spark, path, base) == (1, 0, 1)
    assert run(spark, path, base) == (0, 1, 1)
    area = R.Area(spark, base)
    assert {x.mensaje for x in area.files().where("estado = 'Error'").collect()} == {R.NO_SHEETS}
    assert area.landed("principal").count() == 3
    folder(b=CATALOGUE, c=KARDEX)
    assert run(spark, path, base) == (2, 1, 0)


def test_unreadable_line_fails_its_sheet_alone(spark, folder, base):
    assert run(spark, folder(a=MAIN + ['LISTA DE PRODUCTOS,2,1,"abierto'] + KARDEX, b=CATALOGUE), base) == (2, 0, 0)
    area = R.Area(spark, base)
    bad = area.loads().where("estado = 'Error'").collect()
    assert [(x.tipo, x.leidas, x.insertadas) for x in bad] == [("catalogo", 0, 0)] and "abierto" in bad[0].mensaje
    assert area.landed("catalogo").count() == 2 and area.landed("movimientos").count() == 2


def test_failing_loads_are_found_among_many(spark, folder, base):
    books = {f"b{k}": [f"LISTA DE PRODUCTOS,2,{k},n{k},1", f"LISTA DE PRODUCTOS,3,x{k},m,2"] for k in range(6)}

    def prepare(cells, kind):
        rows = R.prepare_rows(cells, kind)
        fail = F.col("codigo_raw").isin("1", "4")
        return rows.withColumn("codigo_raw", F.when(fail, F.raise_error(F.lit("mala celda"))).otherwise(F.col("codigo_raw")))
    assert run(spark, folder(**books), base, prepare=prepare) == (4, 0, 2)
    area = R.Area(spark, base)
    bad = area.loads().where("estado = 'Error'").collect()
    assert len(bad) == 2 and all(x.mensaje for x in bad)
    assert sorted(x.codigo_raw for x in area.landed("catalogo").collect()) == sorted(
        y for k in (0, 2, 3, 5) for y in (str(k), f"x{k}"))


def test_empty_folder_empty_file_and_too_large_file(spark, folder, base, monkeypatch):
    path = folder(vacio=[])
    assert run(spark, path, base) == (0, 0, 1)
    monkeypatch.setattr(files, "MAX_FILE_BYTES", 20)
    assert run(spark, folder(grande=MAIN), str(base) + "2") == (0, 0, 2)
    found = {x.nombre_archivo: x.mensaje for x in R.Area(spark, str(base) + "2").files().collect()}
    assert found == {"vacio.xlsx": R.NO_SHEETS, "grande.xlsx": R.NO_HASH}


def test_counts_that_do_not_add_up_fail_the_load(spark, folder, base, monkeypatch):
    monkeypatch.setattr(R, "_counted", lambda stored, by: stored.groupBy(*by).agg(*[F.lit(1).cast("bigint").alias(c) for c in R.COUNTERS]))
    assert run(spark, folder(a=CATALOGUE), base) == (0, 0, 1)
    assert "not those written" in R.Area(spark, base).loads().first().mensaje


def test_sheet_is_landed_once_in_the_plan(spark, folder):
    from conftest import plan_of
    cells = sheets.scan_workbooks(spark, folder(a=CATALOGUE)).withColumns({"id_carga": F.lit(1), "id_archivo": F.lit(1)}).drop("ruta", "hoja", "rota")
    plan = plan_of(R.prepare_rows(cells, "catalogo"))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_lines_with_and_without_quotes_are_cut_alike(spark, folder):
    plain = ["H,5,a,,b", "H,6", "", "H,7,", ",8,x", "H, 9 ,2026-08-15T00:00:00,xT1,9T9", "H,10," + ",".join(str(k) for k in range(14))]
    quoted = [line + ',"q"' for line in plain]
    cells = lambda name, lines: {x.fila_excel: x for x in sheets.scan_workbooks(spark, folder(**{name: lines})).where(
        F.col("ruta").endswith(f"{name}.xlsx")).collect()}
    a, b = cells("plano", plain), cells("citado", quoted)
    assert set(a) == {5, 6, 7, 8, 9, 10, None} and set(b) == {5, 6, 7, 8, 9, 10, None}
    for k in (5, 6, 7, 8, 9):
        assert a[k].celdas + ["q"] == b[k].celdas and a[k].hoja == b[k].hoja
    assert a[9].celdas == ["2026-08-15", "xT1", "9T9"] and a[10].rescatado == "12,13" and a[None].rescatado == ""


def test_files_of_a_landing_grow_with_rows_and_not_with_loads(spark, folder, base):
    assert run(spark, folder(**{f"b{k}": [f"LISTA DE PRODUCTOS,2,{k},n{k},1"] for k in range(30)}), base) == (30, 0, 0)
    area = R.Area(spark, base)
    assert area.landed("catalogo").select("id_carga").distinct().count() == 30
    assert len(spark.read.parquet(area.path("catalogo")).inputFiles()) < 10


def test_loads_of_a_later_run_stand_beside_earlier_ones(spark, folder, base):
    path = folder(a=CATALOGUE, b=["LISTA DE PRODUCTOS,2,9,Nueve,1"])
    assert run(spark, path, base) == (2, 0, 0)
    before = picture(R.Area(spark, base))[2]["catalogo"]
    assert run(spark, folder(c=["LISTA DE PRODUCTOS,2,5,Cinco,1"]), base) == (1, 2, 0)
    after = picture(R.Area(spark, base))[2]["catalogo"]
    assert len(after) == 4 and set(before) < set(after)


def test_listing_and_naming_ask_the_driver_once(spark, folder, monkeypatch):
    path = folder(**{f"b{k}": [f"x,{k}"] for k in range(12)}, vacio=[])
    reader = spark.read.format("binaryFile").load(path)
    assert sorted(p.rsplit("/", 1)[-1] for p in files.input_paths(reader)) == sorted(f"{n}.xlsx" for n in [*(f"b{k}" for k in range(12)), "vacio"])
    monkeypatch.setattr(type(reader), "inputFiles", lambda self: pytest.fail("one call for each path"))
    found = {x.nombre_archivo: x.tamanio_bytes for x in files.discover_files(spark, path).collect()}
    assert len(found) == 13 and found["vacio.xlsx"] == 0 and found["b0.xlsx"] == 3


def test_files_are_hashed_before_the_sort(spark, folder):
    from conftest import plan_of
    plan = plan_of(files.discover_files(spark, folder(a=CATALOGUE)))
    assert plan.index("rangepartitioning") < plan.index("hashpartitioning(nombre_archivo")
