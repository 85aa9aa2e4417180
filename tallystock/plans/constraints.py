"""Declared constraints: how often each is broken, and the rows that break them.

All constraints of a table are counted together. A row gives one entry (rule, key) for each key that a unique or reference
rule asks about, and one for each row rule that it breaks; parents add their keys. Entries are counted by rule and key, first
inside each task, so a key that many rows share travels once per task, and the table is scanned and shuffled once whatever
the number of its rules.

As in SQL, rows with a null in the key never collide and point nowhere, and a condition that is null is no breach. A column that a
table lacks is null in all rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock import fixed_values as V



@dataclass(frozen=True)
class Check:
    """A declared constraint: ``unique`` and ``reference`` name columns, ``rule`` is a condition on them."""

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    condition: Column | None = None
    parent: DataFrame | None = None
    parent_key: str = ""


def _completed(table: DataFrame, checks: list[Check]) -> DataFrame:
    absent = sorted({c for check in checks for c in check.columns} - set(table.columns))
    return table.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else table


def _key(columns: list[Column]) -> Column:
    """The key as text, null if a part is null."""
    held = columns[0].isNotNull()
    for c in columns[1:]:
        held = held & c.isNotNull()
    return F.when(held, F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(columns)])))


def _own_key(check: Check) -> Column:
    return _key([F.col(c) for c in check.columns])


def _counted(table: DataFrame, checks: list[Check]) -> DataFrame:
    """Rows (regla, clave, filas, es_padre): how many rows hold or break each key of each rule."""
    entries = []
    for number, check in enumerate(checks):
        key = F.when(~check.condition, F.lit("")) if check.kind == "rule" else _own_key(check)
        entries.append(F.when(key.isNotNull(), F.struct(F.lit(number).alias("regla"), key.alias("clave"))))
    rows = table.select(F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(
        "_e.*", F.lit(1).cast("bigint").alias("filas"), F.lit(False).alias("es_padre"))
    for number, check in enumerate(checks):
        if check.kind == "reference":
            key = _key([F.col(check.parent_key).cast(table.schema[check.columns[0]].dataType)])
            rows = rows.unionAll(check.parent.select(
                F.lit(number), key, F.lit(0).cast("bigint"), F.lit(True)).where(key.isNotNull()))
    return rows.groupBy("regla", "clave").agg(F.sum("filas").alias("filas"), F.bool_or("es_padre").alias("es_padre"))


def _breaches(checks: list[Check]) -> Column:
    """Breaches of a counted key: repeats, rows without a parent, rows that break the rule."""
    of = lambda kind: F.col("regla").isin([n for n, c in enumerate(checks) if c.kind == kind])
    none = F.lit(0).cast("bigint")
    return (F.when(of("unique"), F.col("filas") - 1).when(of("reference"), F.when(F.col("es_padre"), none).otherwise(F.col("filas")))
            .otherwise(F.col("filas")))


def constraint_checks(table: DataFrame, checks: list[Check]) -> DataFrame:
    """Breach count per constraint, in one pass over the table."""
    found = _counted(_completed(table, checks), checks).groupBy("regla").agg(F.sum(_breaches(checks)).alias("n"))
    names = table.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*[
        F.struct(F.lit(number).alias("regla"), F.lit(check.name).alias("nombre")) for number, check in enumerate(checks)])))
    return names.join(found, "regla", "left").select(
        F.col("nombre").alias("regla"), F.coalesce("n", F.lit(0).cast("bigint")).alias("incumplimientos"))


def quarantine(table: DataFrame, checks: list[Check]) -> DataFrame:
    """The rows that break a constraint, with the names of those they break (``reglas``).

    All rows that share a key which has to be unique are taken out, as none of them is the right one by itself. Keys are
    counted as for the report; only broken ones meet the rows again.
    """
    whole = _completed(table, checks)
    keyed = [(number, check) for number, check in enumerate(checks) if check.kind != "rule"]
    bad = _counted(whole, [check for _, check in keyed]).where(_breaches([check for _, check in keyed]) > 0).select(
        "regla", "clave") if keyed else None
    broken: dict[int, Column] = {n: ~check.condition for n, check in enumerate(checks) if check.kind == "rule"}
    for place, (number, check) in enumerate(keyed):
        own = bad.where(F.col("regla") == place).select(F.col("clave").alias(f"_bad{number}"))
        whole = whole.join(own, _own_key(check) == F.col(f"_bad{number}"), "left")
        broken[number] = F.col(f"_bad{number}").isNotNull()
    names = F.array_compact(F.array(*[F.when(broken[n], F.lit(check.name)) for n, check in enumerate(checks)]))
    return whole.withColumn("reglas", names).where(F.size("reglas") > 0).select(*table.columns, "reglas")


@dataclass(frozen=True)
class Declared:
    """What the data model says of a table. ``references`` maps a key column to the table it points to."""

    key: str = ""
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    lists: dict[str, list] = field(default_factory=dict)
    not_negative: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, str] = field(default_factory=dict)


# The constraints of the operational tables.
OPERATIONAL = {
    "audit_log": Declared("id_audit", ("esquema", "tabla", "operacion", "usuario_db", "timestamp_utc"),
                          {"esquema": 50, "tabla": 100, "usuario_db": 100, "usuario_app": 100},
                          {"operacion": ["INSERT", "UPDATE", "DELETE"]}),
    "categoria_producto": Declared("id_categoria", ("codigo_categoria", "nombre", "tipo_producto"),
                                   {"codigo_categoria": 10, "nombre": 120, "descripcion": 400},
                                   {"tipo_producto": ["Granular", "Líquido", "Sustrato-Material", "Otro"]},
                                   unique=(("codigo_categoria",), ("nombre",))),
    "marca_proveedor": Declared("id_marca", ("nombre_marca", "tipo_proveedor"), {"nombre_marca": 80, "pais_origen": 50},
                                {"tipo_proveedor": ["Nacional", "Importado", "Desconocido"]}, unique=(("nombre_marca",),)),
    "unidad_medida": Declared("id_unidad", ("codigo", "descripcion"), {"codigo": 10, "descripcion": 60}, unique=(("codigo",),)),
    "bodega": Declared("id_bodega", ("codigo_bodega", "nombre", "tipo_almacenaje"), {"codigo_bodega": 10, "nombre": 80},
                       {"tipo_almacenaje": ["General", "Área Especial", "En Tránsito", "Cuarentena"]}, unique=(("codigo_bodega",),)),
    "tipo_movimiento": Declared("id_tipo_mov", ("codigo", "descripcion", "afecta_stock"), {"codigo": 10, "descripcion": 80},
                                {"afecta_stock": [1, -1]}, unique=(("codigo",),)),
    "tipo_discrepancia": Declared("id_tipo_disc", ("codigo", "nombre", "impacto"), {"codigo": 10, "nombre": 80, "accion_sugerida": 300},
                                  {"impacto": ["Alto", "Medio", "Bajo"]}, unique=(("codigo",), ("nombre",))),
    "producto": Declared("", ("codigo_producto", "nombre", "id_categoria", "id_marca", "id_unidad"), {"codigo_producto": 30},
                         unique=(("codigo_producto",),),
                         references={"id_categoria": "categoria_producto", "id_marca": "marca_proveedor", "id_unidad": "unidad_medida"}),
    "stock_sistema": Declared("id_stock", ("id_producto", "id_bodega", "fecha_saldo", "cantidad_sistema"), {"fuente": 30},
                              not_negative=("cantidad_sistema",), unique=(("id_producto", "id_bodega", "fecha_saldo"),),
                              references={"id_producto": "producto", "id_bodega": "bodega"}),
    "toma_fisica": Declared("id_toma", ("codigo_toma", "fecha_inicio", "responsable", "estado"),
                            {"codigo_toma": 20, "responsable": 120, "aprobado_por": 120},
                            {"estado": ["Planificada", "En Proceso", "Completada", "Cancelada"]}, unique=(("codigo_toma",),)),
    "detalle_toma_fisica": Declared("id_detalle", ("id_toma", "id_producto", "id_bodega", "cantidad_fisica", "cantidad_sistema"),
                                    {"observacion": 500, "contado_por": 120}, not_negative=("cantidad_fisica", "cantidad_sistema"),
                                    unique=(("id_toma", "id_producto", "id_bodega"),),
                                    references={"id_toma": "toma_fisica", "id_producto": "producto", "id_bodega": "bodega",
                                                "id_tipo_disc": "tipo_discrepancia"}),
    "movimiento_inventario": Declared("", ("id_producto", "id_tipo_mov", "fecha_movimiento", "id_bodega", "cantidad", "usuario_registro"),
                                      {"numero_documento": 50, "observacion": 500}, positive=("cantidad",),
                                      references={"id_producto": "producto", "id_bodega": "bodega", "id_tipo_mov": "tipo_movimiento",
                                                  "referencia_toma": "toma_fisica"}),
    "stg_carga": Declared("id_carga", ("nombre_archivo", "estado"), {"nombre_archivo": 300, "hoja": 100, "hash_md5": 32},
                          {"estado": ["Iniciado", "En Proceso", "Completado", "Error", "Rechazado"]}),
    "stg_inventario_raw": Declared("", ("id_carga",), {"codigo_raw": 60, "nombre_raw": 300, "fisico_raw": 30, "sistema_raw": 30,
                                                       "diferencia_raw": 30, "observacion_raw": 600, "categoria_raw": 120},
                                   references={"id_carga": "stg_carga"}),
    "stg_manvert_jiffy_raw": Declared("", ("id_carga",), {"lote_raw": 30, "codigo_raw": 60, "nombre_raw": 300, "estado_lote_raw": 20,
                                                          "fisico_raw": 30, "sistema_raw": 30, "diferencia_raw": 30, "observacion_raw": 600,
                                                          "fecha_venc_raw": 50, "almacenaje_raw": 20}, references={"id_carga": "stg_carga"}),
    "stg_error_log": Declared("", ("id_carga", "tabla_staging", "id_fila_staging"), {"tabla_staging": 60, "campo_erroneo": 60, "regla_violada": 100},
                              {"severidad": ["ERROR", "WARNING", "INFO"]}, references={"id_carga": "stg_carga"}),
}
# The constraints of the star schema. Key ranges do not hold for the unknown-date row, which has zeros on purpose.
STAR = {
    "dim_tiempo": Declared("sk_tiempo"),
    "dim_marca": Declared("", (), {"nombre_marca": 80}, {"tipo_proveedor": ["Nacional", "Importado", "Desconocido"]}, unique=(("nk_marca",),)),
    "dim_categoria": Declared("", (), {}, {"tipo_producto": ["Granular", "Líquido", "Sustrato-Material", "Desconocido"]},
                              unique=(("nk_categoria",), ("nombre_categoria",))),
    "dim_producto": Declared("", ("nk_codigo_producto", "nombre_producto", "sk_marca", "sk_categoria"), {"nombre_producto": 250},
                             {"clasificacion_venc": ["Vencido", "Critico", "Alerta", "Vigilancia", "Normal", "Sin Vencimiento"]}),
    "fact_inventario": Declared("", ("sk_tiempo", "sk_producto", "sk_categoria", "sk_marca", "sk_estado_stock"), {},
                                not_negative=("cantidad_fisica", "cantidad_sistema"), unique=(("sk_tiempo", "sk_producto"),)),
    "fact_discrepancia": Declared("", (), {"observacion_texto": 500}, {"signo_diferencia": ["+", "-"]}, positive=("unidades_diferencia",),
                                  unique=(("sk_tiempo", "sk_producto"),)),
}
_RANGES = {"dim_tiempo": {"trimestre": (1, 4), "mes": (1, 12), "dia_mes": (1, 31), "dia_semana": (1, 7)}}
_UNIQUE_NAMES = {("sk_tiempo", "sk_producto"): "toma y producto unicos"}


def declared_checks(table: str, parents: dict[str, DataFrame] | None = None) -> list[Check]:
    """Constraints the data model declares for a table. ``parents`` maps a key column to the
    table it points to, which holds the key under the same name."""
    own = {**OPERATIONAL, **STAR}[table]

    def rule(name: str, column: str, condition: Column) -> Check:
        return Check(name, "rule", (column,), condition)

    checks = [Check(_UNIQUE_NAMES.get(key, f"{', '.join(key)} unico"), "unique", key)
              for key in ([(own.key,)] if own.key else []) + list(own.unique)]
    for column, (low, high) in _RANGES.get(table, {}).items():
        checks.append(rule(f"{column} en rango", column, (F.col("sk_tiempo") == V.UNKNOWN_KEY) | F.col(column).between(low, high)))
    checks += [rule(f"largo de {c}", c, F.length(c) <= n) for c, n in own.lengths.items()]
    checks += [rule(f"{c} en lista", c, F.col(c).isin(values)) for c, values in own.lists.items()]
    checks += [rule(f"{c} >= 0", c, F.col(c) >= 0) for c in own.not_negative]
    checks += [rule(f"{c} > 0", c, F.col(c) > 0) for c in own.positive]
    checks += [rule(f"{c} no nulo", c, F.col(c).isNotNull()) for c in own.required]
    for key, parent in (parents or {}).items():
        checks.append(Check(f"{key} existe", "reference", (key,), parent=parent, parent_key=key))
    return checks


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Breach counts of all declared constraints of several tables, with references among them."""
    declared = {**OPERATIONAL, **STAR}
    out = None
    for name, table in tables.items():
        parents = {}
        for key, parent in declared[name].references.items():
            if parent in tables:
                held = declared[parent].key or key
                whole = tables[parent] if held in tables[parent].columns else tables[parent].withColumn(held, F.lit(None).cast("string"))
                parents[key] = whole.select(F.col(held).alias(key))
        found = constraint_checks(table, declared_checks(name, parents)).select(F.lit(name).alias("tabla"), "*")
        out = found if out is None else out.unionByName(found)
    return out
