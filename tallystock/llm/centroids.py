"""Centroid clustering in JVM expressions: Lloyd's rounds on whole numbers.

A round is one pass over the stored vectors. ``zip_with`` and ``aggregate`` give the squared distance of a row to each centroid,
whose components are literals of the plan; ``array_min`` of the structs (distance, number) takes the nearest, ties to
the smaller number; sums of all columns by cluster are partial in the scan's tasks, so that each sends at most one row a
cluster, and the driver gets k rows of sums, from which it makes the next literals by exact division. No row of
the table moves, and a cluster that holds a third of all rows costs no more than any other.

Defined cases: vectors that are null, hold a null or a number that is not finite, or (with ``width``) have another
length take no part; without ``width`` all must have one length; null ids take part (their start hash is that of the empty id); repeated
rows are clustered one by one and, of equal hash, start in the order of their components; with fewer rows than k there
are that many centroids; an empty cluster keeps its centroid; an empty table gives no rows; components too large for
exact distances in 64 bits raise an error before any round; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystock.llm.vectors import extent, floored, usable
from tallystock.session import materialize


def whole_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024,
                  width: int | None = None) -> DataFrame:
    """Rows (id, v) of usable vectors, every component x turned into floor(scale * x)."""
    kept = usable(vector) if width is None else usable(vector) & (F.size(vector) == width)
    return df.where(kept).select(F.col(id_column).alias("id"), floored(vector, scale).alias("v"))


def starts(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the k smallest hashes of seed and id."""
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [row.v for row in vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()]


def _literal(centroid: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{x}L' for x in centroid)})")


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the centroid nearest to the column ``v``."""
    def distance(centroid: list[int]) -> Column:
        squares = F.zip_with("v", _literal(centroid), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)
    return F.array_min(F.array(*(F.struct(distance(c).alias("distance"), F.lit(number).alias("cluster"))
                                 for number, c in enumerate(centroids))))


def _next(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    sums = [F.sum(F.element_at("v", place + 1)).alias(f"x{place}") for place in range(len(centroids[0]))]
    found = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v").groupBy("cluster").agg(F.count("*").alias("n"), *sums)
    moved = list(centroids)
    for cluster, n, *totals in found.collect():
        moved[cluster] = [total // n for total in totals]
    return moved


def cluster(vectors: DataFrame, k: int, rounds: int, seed: str = "3:") -> tuple[DataFrame, list[list[int]]]:
    """Rows (id, cluster, distance) of all ``vectors`` (id, v), and the final centroids."""
    stored = materialize(vectors, "vectors")
    extent(stored, 1 << 61)
    centroids = starts(stored, k, seed)
    if not centroids:
        return stored.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    if not centroids[0]:
        rounds = 0
    for _ in range(rounds):
        moved = _next(stored, centroids)
        if moved == centroids:
            break
        centroids = moved
    found = stored.select("id", nearest(centroids).alias("near")).select("id", "near.cluster", "near.distance")
    return materialize(found, "clusters"), centroids


def op12(spark, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), width=64)
    found, centroids = cluster(vectors, 8, 10)
    inertia = {row.cluster: int(row.total) for row in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    per_cluster = [F.lit(inertia.get(number, 0)).cast("long") for number in range(len(centroids))] or [F.lit(0).cast("long")]
    hashes = [F.sha2(F.lit(",".join(map(str, c))).cast("binary"), 256) for c in centroids] or [F.lit("")]
    at = F.col("cluster") + 1
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", F.element_at(F.array(*per_cluster), at).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.element_at(F.array(*hashes), at).alias("centroid_sha256"))


def _op12_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024) -> str:
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k, v AS c FROM v
  QUALIFY k < {k}
)"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
  SELECT r, any_value(v) AS v, min({k} * CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) + k) AS m
  FROM v, c{n} GROUP BY r
)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT k, coalesce(moved, c) AS c FROM c{n} LEFT JOIN (
    SELECT k, list(x ORDER BY place) AS moved FROM (
      SELECT k, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
      FROM (SELECT m % {k} AS k, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{n}) GROUP BY k, place)
    GROUP BY k) USING (k)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, m // {k} AS distance, CAST(sum(m // {k}) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(m // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON k = m % {k}
"""


OP12_SQL = _op12_sql()
