"""Nothing is lost: writes, unknown members, totals, repeated lookup keys, pushed filters."""

import pytest
from pyspark.sql import functions as F

from tallystock import session
from tallystock.catalog.inputs import COUNT_KEY, Inputs
from tallystock.catalog.star_sql import fact
from tallystock.operators import lookups
from tallystock.plans import history, kpis, movements, star
from tallystock.sources import tables
from conftest import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def inputs(spark):
    return Inputs(spark, SF)


def test_writing_a_count_leaves_the_others(spark, inputs, tmp_path):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        rows, path = fact(inputs), str(tmp_path / "fact")
        for year in (1998, 1999, 1998):
            tables.write_fact(rows.where(F.col("sk_tiempo") == year * 10000 + 1231), path)
        got = {r.sk_tiempo: r["count"] for r in spark.read.parquet(path).groupBy("sk_tiempo").count().collect()}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    want = {r.sk_tiempo: r["count"] for r in rows.groupBy("sk_tiempo").count().collect()}
    assert got == {k: want[k] for k in (19981231, 19991231)}


def test_no_silent_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf, sparkContext = Conf(), type("C", (), {"master": "spark://host:7077"})
    with pytest.raises(ValueError):
        session.shared_folder(Cluster())


def test_all_reports_of_a_count_agree(inputs):
    rows, dates, categories = fact(inputs, True), inputs.dates(), inputs["inv_category"]
    total = rows.count()
    assert rows.where("sk_categoria = -1").count() > 0
    assert kpis.kpi_ira(rows, dates, categories).agg(F.sum("total_skus")).first()[0] == total
    assert kpis.kpi_stockout(rows, dates, categories).agg(F.sum("total_skus")).first()[0] == total
    report = {r.nombre_categoria: r.total_skus for r in kpis.stockout_total(rows, dates, categories, COUNT_KEY).collect()}
    assert report.pop("TOTAL GLOBAL") == total == sum(report.values())
    assert kpis.dashboard(rows, dates, COUNT_KEY).first().total_skus == total
    assert kpis.brand_share(rows, inputs["inv_brand"], COUNT_KEY).agg(F.sum("num_skus")).first()[0] == total


def test_total_counts_facts_that_no_dimension_knows(inputs):
    rows = fact(inputs, True)
    few = inputs["inv_category"].where("sk_categoria < 3")
    report = kpis.stockout_total(rows, inputs.dates(), few, COUNT_KEY)
    assert report.where("nombre_categoria = 'TOTAL GLOBAL'").first().total_skus == rows.count()
    empty = kpis.stockout_total(rows.limit(0), inputs.dates(), few, COUNT_KEY).collect()
    assert [(r.nombre_categoria, r.total_skus, r.sk_tiempo) for r in empty] == [("TOTAL GLOBAL", 0, COUNT_KEY)]


def test_absent_keys_point_to_the_unknown_member(rows):
    counts = rows([(1, 7), (2, 8), (3, None)], "id long, sk_marca int")
    brands = rows([(7,), (7,), (-1,)], "sk_marca int")
    got = star.known_keys(counts, {"sk_marca": brands}).collect()
    assert sorted((r.id, r.sk_marca) for r in got) == [(1, 7), (2, -1), (3, -1)]


def test_repeated_lookup_keys_do_not_add_rows(inputs):
    flow = movements.outflows(inputs["inv_outflow"])
    once = movements.movement_rows(flow, "serie", inputs["inv_product"])
    twice = movements.movement_rows(flow, "serie", inputs["inv_repeated_product"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_declared_unique_keys_need_no_window(rows):
    left, side = rows([("a",)], "c string"), rows([("a", 1)], "k string, v int")
    assert "Window" in plan_of(lookups.lookup_or_null(left, "c", side, "k", {"v": "v"}))
    assert "Window" not in plan_of(lookups.lookup_or_null(left, "c", side, "k", {"v": "v"}, unique=True))


def test_mark_reaches_the_scan(inputs):
    fresh = history.incremental_rows(inputs.table("lineitem").select("l_orderkey", "l_shipdate"), "l_shipdate",
                                     inputs["inv_control"], "ETL_FACT_INVENTARIO")
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(fresh)


def test_repeated_incoming_keys_open_one_version(inputs):
    incoming = inputs["inv_product_v2"]
    twice = incoming.unionAll(incoming.withColumn("nombre", F.concat("nombre", F.lit(" z"))))
    merged = history.scd2_merge(history.first_versions(inputs["inv_product_v1"], "2001-01-01"), twice, "2001-12-31")
    assert merged.where("es_registro_activo").groupBy("id").count().where("count > 1").count() == 0
