"""Facts, dimensions, versions, sinks and reports."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.catalog.inputs import AS_OF, COUNT_KEY, Inputs
from tallystock.catalog.star_sql import discrepancy, fact, products
from tallystock.functions.dates import calendar_columns
from tallystock.functions.measures import count_if, ratio_pct
from tallystock.operators import columns as C
from tallystock.plans import history as H
from tallystock.plans import kpis, star
from tallystock.plans.movements import last_inflow, light_columns
from tallystock.plans.quality import Check, constraint_checks
from tallystock.session import materialize, shared_folder
from tallystock.sources import seeds, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


def test_date_dimension(spark):
    days = seeds.date_dimension(spark)
    assert days.count() == 4018
    row = days.where("sk_tiempo = 20210101").first()
    assert (row.nombre_semana, row.nombre_dia, row.nombre_feriado, row.es_feriado) == ("S53-2021", "Viernes", "Año Nuevo", True)
    assert days.where("sk_tiempo = 20240229").count() == 1
    assert sorted(days.columns) == sorted(seeds.unknown_date(spark).columns) == sorted(calendar_columns(F.col("x")))
    assert seeds.unknown_date(spark).first().sk_tiempo == -1
    assert days.unionByName(seeds.unknown_date(spark)).count() == 4019


def test_light_borders(rows):
    data = [("2026-05-08",), ("2026-06-01",), ("2026-02-07",), ("2026-02-06",), ("2025-05-08",), ("2025-05-07",), (None,)]
    made = light_columns(F.col("d").cast("date"), "2026-05-08")
    got = rows(data, "d string").select(made["dias_inventariado"], made["color_semaforo"], made["id_semaforo"]).collect()
    assert [tuple(r) for r in got] == [
        (0, "Verde", 1), (-24, "Verde", 1), (90, "Verde", 1), (91, "Amarillo", 2), (365, "Amarillo", 2), (366, "Rojo", 3),
        (None, "Revisión", 4)]


def test_last_inflow_skips_noise_and_outflows(rows):
    data = [(1, 1, "2026-01-01", 2.5), (1, 1, "2025-01-01", 10.0), (1, 2, "2026-02-01", 9.0), (2, 1, "2025-03-01", None), (3, 1, "2025-03-01", 5.0)]
    df = rows(data, "id_producto int, id_tipo_mov int, d string, q double").select(
        "id_producto", "id_tipo_mov", F.col("d").cast("date").alias("fecha_movimiento"), F.col("q").cast("decimal(12,2)").alias("cantidad"))
    got = {r.id_producto: str(r.ultima_modificacion) for r in last_inflow(df).collect()}
    assert got == {1: "2025-01-01", 2: "2025-03-01"}


def test_status_and_cause(rows):
    pairs = [(5, 5), (3, 5), (7, 5), (0, 0), (0, 5), (-1, 5)]
    df = rows([(float(a), float(b)) for a, b in pairs], "f double, s double")
    assert [r[0] for r in df.select(star.stock_status(F.col("f"), F.col("s"))).collect()] == [s[1] for s in V.STOCK_STATES]
    notes = [(0, "Pendiente rebajar"), (-1, "pendiente REBAJAR"), (2, "entrega"), (-1, "faltante"), (1, "faltante"), (1, "sobrante"),
             (1, " "), (-1, None), (-1, "nota")]
    df = rows([(d, n) for d, n in notes], "d int, n string")
    assert [r[0] for r in df.select(star.discrepancy_cause(F.col("d"), F.col("n"))).collect()] == [
        "ND", "PR", "EP", "FF", "SCN", "SNR", "SSJ", "FSJ", "FCN"]


def test_expiry_bands(rows):
    days = [-1, 0, 90, 91, 180, 181, 365, 366, None]
    df = rows([(d,) for d in days], "d int")
    assert [r[0] for r in df.select(star.expiry_band(F.col("d"))).collect()] == [
        "Vencido", "Critico", "Critico", "Alerta", "Alerta", "Vigilancia", "Vigilancia", "Normal", "Sin Vencimiento"]


def test_measures_on_empty_input(rows):
    none = rows([], "p boolean")
    row = none.agg(count_if(F.col("p")).alias("n"), ratio_pct(count_if(F.col("p")), F.count("*")).alias("pct")).first()
    assert (row.n, row.pct) == (None, None)


def test_ratio_rounds_half_up(rows):
    df = rows([(1, 800), (12345, 100000), (95, 100)], "a bigint, b bigint")
    assert [str(r[0]) for r in df.select(ratio_pct(F.col("a"), F.col("b"))).collect()] == ["0.13", "12.35", "95.00"]


def test_scd2(inputs):
    first = H.first_versions(inputs["inv_product_v1"], "2001-01-01")
    merged = materialize(H.scd2_merge(first, inputs["inv_product_v2"], AS_OF), "scd2")
    active = merged.where("es_registro_activo")
    assert active.count() == active.select("id").distinct().count()
    assert merged.count() == merged.select("sk_producto").distinct().count()
    closed = merged.where("not es_registro_activo")
    assert {str(r[0]) for r in closed.select("fecha_fin_vigencia").distinct().collect()} == {"2001-12-30"}
    again = H.scd2_merge(merged, inputs["inv_product_v2"], "2002-06-01")
    assert again.exceptAll(merged).count() == 0 and again.count() == merged.count()


def test_journal(rows):
    schema = "id int, n string"
    got = {r.operacion: r for r in H.change_journal(
        rows([(1, "a"), (2, None), (3, "c")], schema), rows([(1, "b"), (2, None), (4, "d")], schema), "t").collect()}
    assert set(got) == {"INSERT", "UPDATE", "DELETE"}
    assert (got["UPDATE"].valores_antes, got["UPDATE"].valores_despues) == ('{"id":1,"n":"a"}', '{"id":1,"n":"b"}')
    assert got["DELETE"].id_registro == "3" and got["INSERT"].valores_antes is None


def test_constraints_follow_sql_nulls(rows):
    df = rows([(1, 5.0, "a"), (1, -1.0, "x"), (None, None, None), (None, 1.0, "a")], "k int, q double, p string")
    parents = rows([("a",)], "p string")
    got = {r.regla: r.incumplimientos for r in constraint_checks(df, [
        Check("unico", "unique", ("k",)), Check("padre", "reference", ("p",), parent=parents, parent_key="p"),
        Check("positivo", "rule", condition=F.col("q") >= 0), Check("lleno", "rule", condition=F.col("k").isNotNull())]).collect()}
    assert got == {"unico": 1, "padre": 1, "positivo": 1, "lleno": 2}


def test_facts_add_up(inputs):
    rows_, diff = fact(inputs), discrepancy(inputs)
    assert rows_.count() == inputs["inv_fact"].count()
    assert diff.count() == rows_.where("flag_discrepancia").count()
    board = kpis.dashboard(fact(inputs, True), inputs.dates(), COUNT_KEY).first()
    by_category = kpis.kpi_ira(fact(inputs, True), inputs.dates(), inputs["inv_category"], COUNT_KEY).agg(
        F.sum("total_skus").alias("n"), F.sum("diferencia_neta").alias("d")).first()
    assert (board.total_skus, board.diferencia_neta_total) == (by_category.n, by_category.d)
    assert board.total_sobrante_uds - board.total_faltante_uds == board.diferencia_neta_total
    assert board.skus_con_discrepancia + board.skus_sin_stock + board.skus_ok >= board.total_skus


def test_name_join_repeats_shared_names(spark, inputs):
    """Two active products with one name give a row each per risk row, as the report's join does."""
    goods = products(inputs).withColumn("nombre_producto", F.lit("x")).where(
        "es_registro_activo and fecha_vencimiento is not null and dias_para_vencer between 0 and 365").limit(3)
    goods = materialize(goods, "goods")
    keys = goods.select("sk_producto")
    stock = fact(inputs).where(F.col("sk_tiempo") == COUNT_KEY).join(keys, "sk_producto").where("cantidad_fisica > 0").count()
    by_name = kpis.expiring_stock(fact(inputs), goods, inputs["inv_brand"], inputs["inv_category"], COUNT_KEY)
    by_key = kpis.expiring_stock(fact(inputs), goods, inputs["inv_brand"], inputs["inv_category"], COUNT_KEY, on="nk_codigo_producto")
    assert (by_name.count(), by_key.count()) == (3 * stock, stock)


def test_columns(rows):
    df = rows([(1, 2, 3)], "a int, b int, c int")
    with pytest.raises(ValueError):
        C.remove_columns(df, ["a", "z"])
    assert C.reorder_columns(df, [("a", "c")]).columns == ["b", "c", "a"]
    assert C.add_columns(df, {"a": F.col("b"), "d": F.col("a 2") + 1}).columns == ["a", "b", "c", "a 2", "d"]


def test_dataset_halts_on_existing(rows, tmp_path):
    df = rows([(1,)], "a int")
    path = str(tmp_path / "set")
    tables.dataset_write(df, path, "halt")
    with pytest.raises(Exception):
        tables.dataset_write(df, path, "halt")
    tables.dataset_write(df, path)
    assert tables.dataset_read(df.sparkSession, path, "a int").count() == 1


def test_mapped_append(rows, tmp_path):
    path = str(tmp_path / "t")
    mapping = {"x": ("cantidad", "decimal(12,2)")}
    tables.mapped_append(rows([("1.5",)], "x string"), mapping, path, {"usuario": F.lit("etl")})
    tables.mapped_append(rows([("2",)], "x string"), mapping, path, {"usuario": F.lit("etl")})
    with pytest.raises(Exception):
        tables.mapped_append(rows([("dos",)], "x string"), mapping, path, {"usuario": F.lit("etl")})
    stored = rows([(1,)], "a int").sparkSession.read.parquet(path)
    assert sorted(r.cantidad for r in stored.collect()) == [Decimal("1.50"), Decimal("2.00")]


def test_seed_is_inserted_once(spark):
    seed = seeds.brand_seed(spark)
    once = tables.insert_if_absent(seed.where("nk_marca = 'Jiffy'"), seed, "nk_marca")
    assert once.count() == 16 and tables.insert_if_absent(once, seed, "nk_marca").count() == 16


def test_constant_tables(spark):
    made = {t: getattr(seeds, t)(spark).count() for t in [
        "brand_seed", "category_seed", "stock_states", "discrepancy_types", "lights", "load_processes"]}
    assert made == {"brand_seed": 16, "category_seed": 3, "stock_states": 6, "discrepancy_types": 9, "lights": 4, "load_processes": 8}
    quoted = seeds.literal_table(spark, [("it's", None, True, 1)], "a string, b string, c boolean, d int").first()
    assert tuple(quoted) == ("it's", None, True, 1)


def test_fact_layout_prunes(inputs, tmp_path):
    path = str(tmp_path / "fact")
    tables.write_fact(fact(inputs), path)
    one = inputs.spark.read.parquet(path).where(F.col("sk_tiempo") == COUNT_KEY)
    assert one.count() == fact(inputs).where(F.col("sk_tiempo") == COUNT_KEY).count()
    assert f"PartitionFilters: [isnotnull(sk_tiempo" in one._jdf.queryExecution().executedPlan().toString()


def test_watermark(rows):
    control = rows([("P", "Completado", 1, "2001-01-02"), ("P", "Error", 2, "2001-01-09"), ("Q", "Completado", 1, None)],
                   "nombre_proceso string, estado_ultimo string, total_cargas int, d string").select(
        "nombre_proceso", "estado_ultimo", "total_cargas", F.col("d").cast("date").alias("ultima_fecha_dato"))
    data = rows([("2001-01-02",), ("2001-01-03",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert [str(r.d) for r in H.incremental_rows(data, "d", control, "P").collect()] == ["2001-01-03"]
    assert H.incremental_rows(data, "d", control, "Q").count() == 2
    moved = {r.nombre_proceso: r for r in H.move_mark(H.latest_marks(control), data, "d", "P").collect()}
    assert moved["P"].total_cargas == 3 and moved["P"].ultima_fecha_dato == datetime.date(2001, 1, 3)
    assert moved["Q"].total_cargas == 1


def test_shared_folder_follows_the_cluster():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs://shared/cp/"}.get(key, default)

    assert shared_folder(Session()) == "hdfs://shared/cp"


@pytest.mark.parametrize("table", ["dim_tiempo", "dim_marca", "dim_producto", "fact_inventario", "fact_discrepancia"])
def test_declared_checks_hold(spark, inputs, table):
    from tallystock.plans.quality import declared_checks

    held = {
        "dim_tiempo": lambda: seeds.date_dimension(spark).unionByName(seeds.unknown_date(spark)),
        "dim_marca": lambda: seeds.brand_seed(spark), "dim_producto": lambda: products(inputs),
        "fact_inventario": lambda: fact(inputs), "fact_discrepancia": lambda: discrepancy(inputs)}[table]()
    parents = {"sk_estado_stock": seeds.stock_states(spark)} if table == "fact_inventario" else None
    report = constraint_checks(held, declared_checks(table, parents)).collect()
    assert report and {r.incumplimientos for r in report} == {0}
