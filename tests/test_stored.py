"""Constraints in one pass, versions in buckets, facts side by side, kept rows."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallystock.operators.aggregates import dedupe_by_key
from tallystock.operators.filters import snapshot_filter
from tallystock.plans import versions as S
from tallystock.plans.constraints import OPERATIONAL, Check, check_tables, constraint_checks, declared_checks, quarantine
from tallystock.plans.quality import warning_mask, warnings
from tallystock.sources.tables import store_fact

SCHEMA = "id long, nombre string, presentacion string, fecha_vencimiento date"


def checks_of(parents):
    return [Check("clave", "unique", ("a", "b")), Check("a unico", "unique", ("a",)), Check("padre", "reference", ("c",), parent=parents, parent_key="c"),
            Check("q >= 0", "rule", ("q",), F.col("q") >= 0), Check("q no nulo", "rule", ("q",), F.col("q").isNotNull()),
            Check("sin columna no nulo", "rule", ("z",), F.col("z").isNotNull())]


def broken_of(data, parents):
    """Names of the broken constraints of each row."""
    out = []
    for x in data:
        names = set()
        if sum((y[0], y[1]) == (x[0], x[1]) for y in data) > 1 and None not in (x[0], x[1]):
            names.add("clave")
        if x[0] is not None and sum(y[0] == x[0] for y in data) > 1:
            names.add("a unico")
        if x[2] is not None and x[2] not in parents:
            names.add("padre")
        if x[3] is not None and x[3] < 0:
            names.add("q >= 0")
        if x[3] is None:
            names.add("q no nulo")
        out.append(names | {"sin columna no nulo"})
    return out


def test_breaches_and_quarantine_by_brute_force(rows):
    r = random.Random(1)
    data = [(r.choice([None, *range(60)]), r.choice([None, "x", "y"]), r.choice([None, 1, 2, 3, 9]), r.choice([None, -1.0, 0.0, 2.0])) for _ in range(150)]
    data += [(7, "hot", 9, 1.0)] * 500
    table = rows(data, "a int, b string, c int, q double")
    parents = rows([(1,), (2,), (2,), (None,)], "c long")
    want = broken_of(data, {1, 2})
    report = {x.regla: x.incumplimientos for x in constraint_checks(table, checks_of(parents)).collect()}
    keys = [x[:2] for x in data if None not in x[:2]]
    first = [x[0] for x in data if x[0] is not None]
    assert report == {
        "clave": len(keys) - len(set(keys)), "a unico": len(first) - len(set(first)), "padre": sum("padre" in w for w in want),
        "q >= 0": sum("q >= 0" in w for w in want), "q no nulo": sum("q no nulo" in w for w in want), "sin columna no nulo": len(data)}
    found = quarantine(table, checks_of(parents))
    assert found.columns == ["a", "b", "c", "q", "reglas"]
    assert sorted((str(tuple(x)[:4]), tuple(sorted(x.reglas))) for x in found.collect()) == sorted(
        (str(d), tuple(sorted(w))) for d, w in zip(data, want, strict=True))


def test_constraints_scan_and_shuffle_once(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1).alias("c"), F.lit(1.0).alias("q")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(constraint_checks(table, [c for c in checks_of(None) if c.kind != "reference"]))
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning(regla") == 2  # by rule and key, then by rule


def test_every_operational_table_can_be_checked(spark, rows):
    tables = {name: rows([(1,)], "otra int") for name in OPERATIONAL}
    report = check_tables(tables).collect()
    assert {x.tabla for x in report} == set(OPERATIONAL)
    required = {(t, f"{c} no nulo") for t, d in OPERATIONAL.items() for c in d.required}
    assert {(x.tabla, x.regla) for x in report if x.incumplimientos} == required
    assert len(declared_checks("detalle_toma_fisica")) == 11
    assert constraint_checks(rows([], "otra int"), declared_checks("bodega")).agg(F.sum("incumplimientos")).first()[0] == 0


def versions_of(loads):
    """Versions (id, values, begin, end) after loads (day, {id: values}), by plain Python."""
    opened, closed = {}, []
    for day, state in loads:
        for key, value in state.items():
            if key in opened and opened[key][0] != value:
                closed.append((key, *opened.pop(key), day - 1))
            opened.setdefault(key, (value, day))
    return sorted([*closed, *((k, v, b, None) for k, (v, b) in opened.items())], key=str)


def table_state(table):
    out = []
    for x in table.versions().collect():
        end = None if x.es_registro_activo else x.fecha_fin_vigencia.day
        out.append((x.id, (x.nombre, x.presentacion, x.fecha_vencimiento), x.fecha_inicio_vigencia.day, end))
    return sorted(out, key=str)


def states(r, days):
    return [(day, {k: (r.choice(["a", "b", None]), r.choice(["p", None]), None) for k in range(40) if r.random() < 0.8}) for day in days]


def load(spark, table, day, state):
    rows = [(k, *v) for k, v in state.items()]
    return {x.cambio: x.filas for x in table.load(spark.createDataFrame(rows + rows[:3], SCHEMA), f"2026-01-{day:02d}").collect()}


def test_three_loads_in_a_row(spark, tmp_path):
    loads = states(random.Random(2), (5, 9, 20))
    table = S.VersionedTable(spark, str(tmp_path / "dim"), buckets=8)
    for n, (day, state) in enumerate(loads):
        load(spark, table, day, state)
        assert table_state(table) == versions_of(loads[:n + 1])
    keys = [x.sk_producto for x in table.versions().collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    assert load(spark, table, 25, loads[-1][1]).keys() <= {"same", "absent"}
    assert table_state(table) == versions_of(loads)


@pytest.mark.parametrize("after", ["cerrada", "half of abierta"])
def test_killed_load_is_continued(spark, tmp_path, monkeypatch, after):
    loads = states(random.Random(3), (5, 9))
    table = S.VersionedTable(spark, str(tmp_path / "dim"), buckets=4)
    load(spark, table, *loads[0])
    replace = S.VersionedTable._replace

    def lost(self, rows, name, key):
        if name == "abierta":
            if after != "cerrada":
                replace(self, rows.where("cubeta < 2"), name, key)
            raise KeyboardInterrupt
        replace(self, rows, name, key)
    monkeypatch.setattr(S.VersionedTable, "_replace", lost)
    with pytest.raises(KeyboardInterrupt):
        load(spark, table, *loads[1])
    monkeypatch.undo()
    load(spark, table, *loads[1])
    assert table_state(table) == versions_of(loads)
    keys = [x.sk_producto for x in table.versions().collect()]
    assert len(keys) == len(set(keys))


def test_load_compares_once_and_leaves_other_partitions_alone(spark, tmp_path, monkeypatch):
    table = S.VersionedTable(spark, str(tmp_path / "dim"), buckets=16)
    for day in (3, 6):
        load(spark, table, day, {k: (f"{day}", None, None) for k in range(50)})
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "dim").rglob("*.parquet")}
    plans = []
    materialize = S.materialize

    def seen(df, label):
        plans.append(plan_of(df))
        return materialize(df, label)
    monkeypatch.setattr(S, "materialize", seen)
    load(spark, table, 9, {k: ("6" if k else "new", None, None) for k in range(50)})
    whole = "\n".join(plans)
    assert whole.count("FullOuter") == 1 and sum("FileScan" in line and "cubeta#" in line.split("Batched")[0] for line in plans[0].splitlines()) == 1
    assert sum("FileScan" in line and "fin#" in line and "PartitionFilters: [isnotnull(fin" not in line for line in whole.splitlines()) == 0
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "dim").rglob("*.parquet")}
    gone = {p.parent.name for p in before if p not in now}
    assert len(gone) == 1 and next(iter(gone)).startswith("cubeta=")
    assert all(now[p] == t for p, t in before.items() if p in now)


def test_facts_of_one_layout_join_without_a_shuffle(spark, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, amount in (("juntos_a", 3000), ("juntos_b", 700)):
            rows = spark.range(amount).select((F.col("id") % 3 + 20260101).cast("int").alias("sk_tiempo"), F.col("id").alias("sk_producto"),
                                              F.col("id").alias(f"v_{name}"))
            store_fact(rows, name, str(tmp_path / name), 4)
            assert len(list((tmp_path / name / "toma=20260101").glob("*.parquet"))) <= 4
        a, b = spark.table("juntos_a"), spark.table("juntos_b")
        both = a.drop("toma").join(b.drop("toma"), ["sk_tiempo", "sk_producto"])
        plan = plan_of(both)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("FileScan") == 2
        assert both.count() == 700 and both.where("v_juntos_a <> v_juntos_b").count() == 0
        one = snapshot_filter(a, 20260102)
        assert "PartitionFilters: [isnotnull(toma" in plan_of(one) and one.count() == 1000 and "toma" not in one.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("juntos_a", "juntos_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_kept_row_is_the_first_and_whole(rows):
    r = random.Random(4)
    data = [(r.choice([None, "a", "b"]), r.choice([1, 2, None]), r.choice(["x", "y", None]), k) for k in range(200)]
    data += data[:50] + [("hot", 5, "z", k) for k in range(400)]
    df = rows(data, "clave string, orden int, dato string, n int")
    kept = {x.clave: tuple(x) for x in dedupe_by_key(df, "clave", [F.col("orden"), F.col("n")]).collect()}
    order = lambda x: (x[1] is not None, x[1] or 0, x[3])  # noqa: E731  null comes first, as in a sort
    assert kept == {k: min((x for x in data if x[0] == k), key=order) for k in {x[0] for x in data}}
    assert dedupe_by_key(df, ["clave", "dato"]).count() == len({(x[0], x[2]) for x in data})
    again = dedupe_by_key(df.repartition(7), "clave").collect()
    assert sorted(map(str, again)) == sorted(map(str, dedupe_by_key(df.coalesce(1), "clave").collect()))
    assert dedupe_by_key(df.limit(0), "clave").collect() == []


def test_rows_without_a_warning_are_gone_before_the_generator(rows):
    landed = rows([(1, "0", None), (2, "5", None), (3, None, None)], "fila_excel int, precio1_raw string, lnd_x string")
    plan = plan_of(warnings(landed, "catalogo", ["fila_excel"]))
    assert "Generate" in plan and plan.index("Filter") > plan.index("Generate")  # a plan is printed from the top
    assert sorted(x.fila_excel for x in warnings(landed, "catalogo", ["fila_excel"]).collect()) == [1, 3]
    assert [x[0] for x in landed.orderBy("fila_excel").select(warning_mask("catalogo")).collect()] == [1, 0, 1]


def test_dictionary_serves_all_columns_in_one_join(rows):
    from tallystock.plans.masters import with_master_ids

    r = random.Random(5)
    data = [(k, r.choice(["a", "b", None, "x"]), r.choice(["a", "c", None])) for k in range(300)] + [(k, "a", "a") for k in range(300, 900)]
    values = [("u", "a", 1), ("u", "b", 2), ("v", "a", 7), ("v", "c", 8), ("v", None, 9), ("w", "x", 3)]
    df, dictionary = rows(data, "n int, u string, v string"), rows(values, "columna string, valor string, id int")
    found = with_master_ids(df, dictionary, {"u": "id_u", "v": "id_v"})
    assert plan_of(found).count("Join") == 2
    ids = {(c, v): i for c, v, i in values if v is not None}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((n, u, v, ids.get(("u", u)), ids.get(("v", v)))) for n, u, v in data)


def test_seed_tables_are_whole(spark):
    from tallystock.sources import seeds

    assert seeds.stock_states(spark).where("descripcion is null").count() == 0
    assert seeds.discrepancy_types(spark).where("descripcion is null or accion_recomendada is null").count() == 0
    unknown = seeds.unknown_members(spark)
    product = unknown["dim_producto"].first()
    assert (product.sk_marca, product.sk_categoria, str(product.fecha_fin_vigencia), product.es_sin_definir) == (-1, -1, "9999-12-31", True)
    assert unknown["dim_marca"].first().es_sin_definir and not seeds.brand_seed(spark).first().es_sin_definir
