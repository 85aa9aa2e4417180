"""A stored dimension with versions: open ones apart from closed ones, and only what a load touches is written.

Open versions lie in buckets by a hash of the key, closed ones in folders by the day they ended. A load compares the incoming
rows with the open versions once, by one full outer join, and stores the result. Then it writes the versions that end to the
folder of their day, and after that the buckets that hold a change; closed versions of other days are neither read nor
written, nor are buckets without a change.

A load that is killed can be run again: the folder of the day keeps what an attempt before has closed, and buckets that
were already swapped hold the new versions, which then count as the same. Loads of one dimension must not overlap, and go
forward in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.operators.windows import number_rows
from tallystock.plans.history import VERSIONED, compare
from tallystock.session import materialize

BUCKETS = 64
SCHEMA = ("sk_producto bigint, id bigint, nombre string, presentacion string, fecha_vencimiento date, fecha_inicio_vigencia date, "
          "fecha_fin_vigencia date")


class VersionedTable:
    """A versioned dimension below ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        empty = spark.createDataFrame([], SCHEMA)
        for name, key, kind in (("abierta", "cubeta", "int"), ("cerrada", "fin", "date")):
            empty.withColumn(key, F.lit(None).cast(kind)).write.mode("ignore").partitionBy(key).parquet(f"{self.path}/{name}")

    def _stored(self, name: str, key: str) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMA}, {key}").parquet(f"{self.path}/{name}")

    def open_versions(self) -> DataFrame:
        return self._stored("abierta", "cubeta int")

    def closed_versions(self) -> DataFrame:
        return self._stored("cerrada", "fin date")

    def versions(self) -> DataFrame:
        """All versions, as one table."""
        active = self.open_versions().drop("cubeta").withColumn("es_registro_activo", F.lit(True))
        return active.unionByName(self.closed_versions().drop("fin").withColumn("es_registro_activo", F.lit(False)))

    def _replace(self, rows: DataFrame, name: str, key: str) -> None:
        """Write whole partitions; others stay."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(f"{self.path}/{name}")

    def load(self, incoming: DataFrame, as_of: str) -> DataFrame:
        """Bring the dimension to ``incoming`` as of a day; rows (cambio, filas) of what was found.

        Changed versions end the day before and new ones begin; a product that is absent keeps its open version.
        New surrogate keys go on from the highest one, in key order; it is always that of an open version.
        """
        day = F.lit(as_of).cast("date")
        opened = self.open_versions().withColumn("es_registro_activo", F.lit(True))
        compared = compare(opened, incoming)
        found = materialize(compared.select("cambio", F.struct("o.*").alias("o"), F.struct("n.*").alias("n")), "compared")
        names = [f.name for f in self.spark.createDataFrame([], SCHEMA).schema]

        ending = found.where("cambio = 'changed'").select("o.*").withColumns(
            {"fecha_fin_vigencia": F.date_sub(day, 1), "fin": F.date_sub(day, 1)}).select(*names, "fin")
        held = materialize(self.closed_versions().where(F.col("fin") == F.date_sub(day, 1)).join(
            ending.select("sk_producto"), "sk_producto", "left_anti").select(*names, "fin").unionByName(ending), "ending")
        self._replace(held, "cerrada", "fin")

        bucket = F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int")
        fresh = found.where(F.col("cambio").isin("new", "changed")).select("n.id", *[f"n.{c}" for c in VERSIONED])
        highest = opened.agg(F.coalesce(F.max("sk_producto"), F.lit(0))).first()[0]
        numbered = materialize(number_rows(fresh, [F.col("id")], "_n").select(
            (F.lit(highest) + F.col("_n")).cast("bigint").alias("sk_producto"), "id", *VERSIONED, day.alias("fecha_inicio_vigencia"),
            F.lit(V.OPEN_END).cast("date").alias("fecha_fin_vigencia")).withColumn("cubeta", bucket), "opening")
        touched = numbered.select("cubeta").distinct()
        stay = found.where(F.col("cambio").isin("same", "absent")).select("o.*").select(*names, "cubeta").join(
            touched, "cubeta", "left_semi").select(*names, "cubeta")
        if numbered.limit(1).count():
            self._replace(stay.unionByName(numbered.select(*names, "cubeta")).repartition("cubeta"), "abierta", "cubeta")
        return found.groupBy("cambio").agg(F.count("*").alias("filas"))
