"""Stored moments that merge: fits and climatologies that new steps update.

A moment table has one row per scope (the ``by`` columns) and feature: ``feature,
n, mean, m2, low, high``, where ``m2`` is the sum of squared differences from the
mean. Parts over disjoint rows merge exactly, in any order, so appended steps
never need the old rows again. Every difference is taken from a mean, so a common
offset of 1e8 costs no digits. NULLs are skipped; a scope without values has n = 0
and NULL figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stpanel.operators.panel import NODE
from stpanel.operators.scaling import KINDS, SCOPES, Scaler
from stpanel.operators.storage import materialize
from stpanel.sources.appends import append_once, read_appends

FIGURES = ("n", "mean", "m2", "low", "high")


def moments(panel: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Moments of each feature per scope, in one pass with partial aggregates."""
    found = panel.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                (F.var_pop(c) * F.count(c)).alias("m2"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(f"_m{i}")
            for i, c in enumerate(features)
        ]
    )
    rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"_m{i}.{f}").alias(f) for f in FIGURES]) for i, c in enumerate(features)]
    return found.select(*by, F.inline(F.array(*rows)))


def merge(parts: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """One row per scope from any number of parts of it.

    Deviations are taken from the mean of one part per scope, which lies among
    the others, and then from the merged mean: one shuffle of the small parts.
    """
    some = F.min(F.when(F.col("n") > 0, F.struct(-F.col("n"), F.col("mean")))).over(Window.partitionBy(*by))
    rows = parts.withColumn("_ref", some["mean"])
    n, apart = F.col("n"), F.col("mean") - F.col("_ref")
    sums = rows.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.first("_ref").alias("_ref"),
        F.sum(n * apart).alias("_d"),
        F.sum("m2").alias("_m2"),
        F.sum(n * apart * apart).alias("_dd"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    total = F.nullif(F.col("n"), F.lit(0))
    spread = F.col("_m2") + F.col("_dd") - F.col("_d") * F.col("_d") / total
    return sums.select(
        *by, "n", (F.col("_ref") + F.col("_d") / total).alias("mean"), F.when(F.col("n") > 0, F.greatest(spread, F.lit(0.0))).alias("m2"), "low", "high"
    )


def scaler(parts: DataFrame, features: Sequence[str], kind: str = "std", scope: str = "feature", ddof: int = 0, node: str = NODE) -> Scaler:
    """The normalizer that ``fit`` gives on all rows behind the parts.

    Parts may be finer than the scope: moments per node serve every scope. A NaN
    among the values makes the figures NaN, as in ``fit``.
    """
    if kind not in KINDS or scope not in SCOPES:
        raise ValueError(f"unknown normalizer or scope: {kind!r}, {scope!r}")
    if kind == "none":
        return Scaler(kind, scope, tuple(features), node, None)
    scope = "column" if kind == "cmax" else scope
    wanted = parts.filter(F.col("feature").isin(list(features)))
    keys = {"global": [], "feature": ["feature"], "column": [node, "feature"]}[scope]
    if not keys:
        wanted, keys = wanted.withColumn("_all", F.lit(1)), ["_all"]
    whole = merge(wanted, keys)
    if kind == "std":
        offset, scale = F.col("mean"), F.sqrt(F.try_divide(F.col("m2"), F.col("n") - ddof))
    else:
        width = F.col("high") - F.col("low")
        offset, scale = F.col("low"), F.when(width == 0, F.lit(1.0)).otherwise(width) if kind == "cmax" else width
    made = whole.select(*keys, offset.alias("offset"), scale.alias("scale"))
    mine = lambda c: F.col("feature") == c if scope != "global" else F.lit(True)
    stats = made.groupBy(*([node] if scope == "column" else [])).agg(
        *[F.max(F.when(mine(c), F.col(p))).alias(f"{c}__{p}") for p in ("offset", "scale") for c in features]
    )
    return Scaler(kind, scope, tuple(features), node, materialize(stats, "scaler"))


def climatology(parts: DataFrame, node_dim: DataFrame, target: str, name: str = "clim") -> DataFrame:
    """Per-node mean of the target, 0 for nodes without values."""
    means = merge(parts.filter(F.col("feature") == target), [NODE]).select(NODE, F.col("mean").alias(name))
    return node_dim.select(NODE).join(means, NODE, "left").select(NODE, F.coalesce(name, F.lit(0.0)).alias(name))


def append_moments(panel: DataFrame, features: Sequence[str], path: str, batch: str, by: Sequence[str] = (NODE,)) -> bool:
    """Add the moments of newly arrived rows; a batch that is there already adds nothing."""
    return append_once(moments(panel, features, by), path, batch)


def read_moments(spark, path: str, by: Sequence[str] = (NODE,)) -> DataFrame:
    """The moments of all appended batches together."""
    return merge(read_appends(spark, path).drop("batch"), [*by, "feature"])
