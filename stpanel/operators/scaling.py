"""Normalizers: fit once, then transform and invert anywhere.

Fitting reads its rows once and stores the statistics as a table. One-row
statistics then enter a plan as a scalar subquery on that table, per-node
statistics as a join on the node, so no later use reads the fitted rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.functions.scalar import ieee_div
from stpanel.operators.panel import NODE
from stpanel.operators.storage import attach, materialize

KINDS = ("none", "std", "max01", "max11", "cmax")
SCOPES = ("global", "feature", "column")


@dataclass(frozen=True)
class Scaler:
    """A fitted normalizer.

    ``stats`` holds an offset and a scale per feature, in one row or, for the
    "column" scope, in one row per node.
    """

    kind: str
    scope: str
    features: tuple[str, ...]
    node: str
    stats: DataFrame | None

    def transform(
        self, df: DataFrame, columns: Mapping[str, str] | None = None, suffix: str = "_scaled"
    ) -> DataFrame:
        """Add the scaled features; an empty suffix replaces them.

        ``columns`` maps other columns to the feature whose statistics apply.
        """
        names = {c: c for c in self.features} if columns is None else columns
        return self._apply(
            df, {c + suffix: (c, feature) for c, feature in names.items()}, self._forward
        )

    def inverse(self, df: DataFrame, columns: Mapping[str, str], suffix: str = "") -> DataFrame:
        """Undo the scaling of ``{column: feature whose statistics apply}``."""
        return self._apply(
            df, {c + suffix: (c, feature) for c, feature in columns.items()}, self._backward
        )

    def _forward(self, x: Column, offset: Column, scale: Column) -> Column:
        y = ieee_div(x - offset, scale)
        return y * 2.0 - 1.0 if self.kind == "max11" else y

    def _backward(self, y: Column, offset: Column, scale: Column) -> Column:
        if self.kind == "max11":
            y = (y + 1.0) / 2.0
        return y * scale + offset

    def _apply(self, df: DataFrame, outputs, formula) -> DataFrame:
        if self.kind == "none":
            return df.withColumns({out: F.col(c) for out, (c, _) in outputs.items()})
        if self.scope == "column":
            rows = attach(df, self.stats, self.node, "left")
        else:
            rows = df.withColumn("_stats", self.stats.select(F.struct("*")).scalar())

        def stat(feature: str, part: str) -> Column:
            name = f"{feature}__{part}"
            return F.col(name) if self.scope == "column" else F.col(f"_stats.{name}")

        made = {
            out: formula(F.col(c), stat(f, "offset"), stat(f, "scale"))
            for out, (c, f) in outputs.items()
        }
        kept = [F.col(c) for c in df.columns if c not in made]
        return rows.select(*kept, *[col.alias(out) for out, col in made.items()]).select(
            *df.columns, *[c for c in made if c not in df.columns]
        )


def fit(
    panel: DataFrame,
    features: Sequence[str],
    kind: str = "std",
    scope: str = "feature",
    ddof: int = 0,
    node: str = NODE,
) -> Scaler:
    """Fit a normalizer on the given rows.

    Scopes: "global" is one value over all features, "feature" one per feature,
    "column" one per node and feature. ``cmax`` is always per column and treats
    a zero range as 1. ``ddof=0`` is the population deviation, ``ddof=1`` the
    sample deviation. Pass only training rows to keep later splits out of the fit.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown normalizer: {kind!r}")
    if scope not in SCOPES:
        raise ValueError(f"unknown scope: {scope!r}")
    names = tuple(features)
    if kind == "none":
        return Scaler(kind, scope, names, node, None)
    if kind == "cmax":
        scope = "column"
    grouped = panel.groupBy(node) if scope == "column" else panel.groupBy()
    if kind == "std":
        deviation = F.stddev_samp if ddof == 1 else F.stddev_pop
        if scope == "global":
            stats = _pooled_std(grouped, names, ddof)
        else:
            stats = grouped.agg(
                *[F.avg(c).alias(f"{c}__offset") for c in names],
                *[deviation(c).alias(f"{c}__scale") for c in names],
            )
    else:
        stats = _ranges(grouped, names, pooled=scope == "global", unit_zero=kind == "cmax")
    return Scaler(kind, scope, names, node, materialize(stats, "scaler"))


def _pooled_std(grouped, names: Sequence[str], ddof: int) -> DataFrame:
    """Mean and deviation over all features together, from per-feature moments."""
    moments = grouped.agg(
        *[F.count(c).cast("double").alias(f"{c}_n") for c in names],
        *[F.avg(c).alias(f"{c}_m") for c in names],
        *[F.var_pop(c).alias(f"{c}_v") for c in names],
    )
    n = sum(F.col(f"{c}_n") for c in names)
    mean = sum(F.col(f"{c}_n") * F.col(f"{c}_m") for c in names) / n
    pooled = moments.withColumns({"_n": n, "_m": mean})
    spread = sum(
        F.col(f"{c}_n")
        * (F.col(f"{c}_v") + (F.col(f"{c}_m") - F.col("_m")) * (F.col(f"{c}_m") - F.col("_m")))
        for c in names
    )
    std = F.sqrt(spread / (F.col("_n") - ddof))
    return pooled.select(
        *[F.col("_m").alias(f"{c}__offset") for c in names],
        *[std.alias(f"{c}__scale") for c in names],
    )


def _ranges(grouped, names: Sequence[str], pooled: bool, unit_zero: bool) -> DataFrame:
    ends = {c: (F.min(c), F.max(c)) for c in names}
    if pooled and len(names) > 1:
        both = (F.least(*[e[0] for e in ends.values()]), F.greatest(*[e[1] for e in ends.values()]))
        ends = dict.fromkeys(names, both)
    width = {
        c: F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo) if unit_zero else hi - lo
        for c, (lo, hi) in ends.items()
    }
    return grouped.agg(
        *[ends[c][0].alias(f"{c}__offset") for c in names],
        *[width[c].alias(f"{c}__scale") for c in names],
    )


def one_hot(table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each integer column as an array of indicators for every value from min to max.

    The ends are a one-row subquery, so the plan has the same size for any range,
    and an empty or all-NULL column is fine. A NULL value has a NULL array;
    ``one_hot_long`` is the sparse form.
    """
    rows = table.withColumn("_e", _integer_ends(table, cols))
    return rows.select(
        *[_indicators(c).alias(c) if c in cols else F.col(c) for c in table.columns]
    )


def _integer_ends(table: DataFrame, cols: Sequence[str]) -> Column:
    """Smallest and largest value of each column, as one struct."""
    return table.agg(
        F.struct(
            *[F.min(c).cast("long").alias(f"{c}_lo") for c in cols],
            *[F.max(c).cast("long").alias(f"{c}_hi") for c in cols],
        )
    ).scalar()


def _indicators(col: str) -> Column:
    value = F.col(col).cast("long")
    ones = F.transform(
        F.sequence(F.col(f"_e.{col}_lo"), F.col(f"_e.{col}_hi")), lambda v: (v == value).cast("int")
    )
    return F.when(value.isNotNull(), ones)


def one_hot_long(table: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Positions of the ones only: a row per key and column."""
    ends = _integer_ends(table, cols)
    start: Column = F.lit(0).cast("long")
    entries = []
    for c in cols:
        at = start + F.col(c) - F.col(f"_e.{c}_lo")
        entries.append(F.struct(F.lit(c).alias("column"), at.alias("position")))
        start = start + F.col(f"_e.{c}_hi") - F.col(f"_e.{c}_lo") + 1
    return table.withColumn("_e", ends).select(*key, F.inline(F.array(*entries)))
