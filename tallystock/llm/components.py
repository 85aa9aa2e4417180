"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystock.session import materialize


def _point_to_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours are linked to the least node around it: the larger ones, or the others and itself."""
    both = edges.unionAll(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    around = both if larger else both.where("y < x")
    least = around.groupBy("x").agg(F.least("x", F.min("y")).alias("_least"))
    moved = around.join(least, "x")
    if larger:
        return moved.where("y > x").select(F.col("y").alias("x"), F.col("_least").alias("y")).where("x <> y").distinct()
    own = least.select("x", F.col("_least").alias("y"))
    return moved.select(F.col("y").alias("x"), F.col("_least").alias("y")).unionAll(own).where("x <> y").distinct()


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the links (x, y); the component is its least node.

    Each round is two joins on small rows; the number of rounds grows with the logarithm of the longest chain.
    Nothing is collected but one checksum per round. Links with a null end are ignored, repeated links and
    links of a node with itself too; without links there are no rows.
    """
    edges = materialize(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
                        .distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("x", "y")).alias("h")).first()
        if now == state:
            break
        state = now
        if not now.n:
            break
        edges = materialize(_point_to_least(_point_to_least(edges, True), False), "edges")
    own = edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionAll(own)
