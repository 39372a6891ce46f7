"""Graph operators on edge tables ``(src, dst)`` and weighted ``(src, dst, weight)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stpanel.functions.scalar import dot, relu
from stpanel.operators.panel import NODE, TIME
from stpanel.operators.skew import BOUND, dealt, hub_join
from stpanel.operators.storage import attach, materialize

MODES = ("diff", "adv", "pre", "k")


def edge_adjacency(edges: DataFrame) -> DataFrame:
    """Weight 1 per listed edge; repeated edges add up.

    The edges are counted first, from the footers if they are a stored table.
    """
    rows = dealt(edges, edges.count(), "src", "dst")
    return rows.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def edge_weights(
    adjacency: DataFrame,
    vectors: DataFrame | None = None,
    mode: str = "pair",
    alpha: float = 0.2,
    coefficient: float = 1.0,
    bound: int = BOUND,
) -> DataFrame:
    """Scale an adjacency by node vectors ``(node_id, a, b)``.

    The factor is ``relu(tanh(alpha * s))`` with ``s`` the product ``a_i a_j``
    ("diff"), ``a_i b_j - b_i a_j`` ("adv") or ``a_i b_j`` (any other mode).
    "pre" keeps the adjacency and "k" multiplies it by ``coefficient``. Only
    listed edges are scored; all node pairs are never formed. The edges of a node
    with more than ``bound`` of them are spread over several tasks.
    """
    if mode == "pre":
        return adjacency
    if mode == "k":
        return adjacency.withColumn("weight", F.col("weight") * F.lit(float(coefficient)))
    side = {
        end: vectors.select(F.col(NODE).alias(end), F.col("a").alias(f"a_{i}"), F.col("b").alias(f"b_{i}"))
        for end, i in (("src", "i"), ("dst", "j"))
    }
    ends = hub_join(hub_join(adjacency, side["src"], "src", bound), side["dst"], "dst", bound)
    if mode == "diff":
        s = dot("a_i", "a_j")
    elif mode == "adv":
        s = dot("a_i", "b_j") - dot("b_i", "a_j")
    else:
        s = dot("a_i", "b_j")
    factor = relu(F.tanh(F.lit(float(alpha)) * s))
    return ends.select("src", "dst", (factor * F.col("weight")).alias("weight"))


def laplacian(weights: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``diag(out-degree) - transpose(weights)`` as entries ``(row, col, value)``.

    Pass ``nodes`` to list isolated nodes with a zero diagonal. Entries that
    fall on the same cell (self-loops) are added. The diagonal, to which a hub adds
    many entries, is summed on its own first. Pass stored weights: they are read twice
    and counted.
    """
    diagonal = weights.select(F.col("src").alias("row"), F.col("weight").alias("value"))
    if nodes is not None:
        diagonal = diagonal.unionByName(nodes.select(F.col(NODE).alias("row"), F.lit(0.0).alias("value")))
    diagonal = materialize(diagonal.groupBy("row").agg(F.sum("value").alias("value")), "diagonal")
    others = weights.select(
        F.col("dst").alias("row"), F.col("src").alias("col"), (-F.col("weight")).alias("value")
    )
    entries = diagonal.select("row", F.col("row").alias("col"), "value").unionByName(others)
    entries = dealt(entries, diagonal.count() + weights.count(), "row", "col")
    return entries.groupBy("row", "col").agg(F.sum("value").alias("value"))


def diffusion_term(panel: DataFrame, lap: DataFrame, features: Sequence[str]) -> DataFrame:
    """``-L x`` per time step and feature: what flows in minus what flows out.

    Inflow and outflow are both Laplacian entries, so one lookup by node and one
    aggregate do. A node without an entry exchanges nothing and keeps a row of
    zeros. Pass a stored Laplacian (see ``attach``).
    """
    entries = lap.select(
        F.col("col").alias(NODE), F.col("row").alias("_to"), F.col("value").alias("_l")
    )
    return (
        attach(panel.select(TIME, NODE, *features), entries, NODE, "left")
        .groupBy(TIME, F.coalesce("_to", NODE).alias(NODE))
        .agg(*[F.sum(F.coalesce(-F.col("_l"), F.lit(0.0)) * F.col(c)).alias(c) for c in features])
    )
