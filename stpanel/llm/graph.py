"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stpanel.operators.storage import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the star algorithm on edges ``u, v``.

    The large step ties each node's larger neighbours to the smallest node
    nearby; the small step ties the smaller neighbours, and the node itself.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sides = both if large else both.filter("v < u")
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = sides.join(least, "u")
    if large:
        return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    others = tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node without an edge of its own."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        return False
    return edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node that has an edge ``u, v``.

    Alternates large and small stars until only stars are left. Each step is an
    aggregate with partial sums and an equi-join; steps are stored, so a lost
    executor never repeats the whole loop.
    """
    current = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        current = materialize(_star(_star(current, True), False), "edges")
        if _is_forest_of_stars(current):
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
