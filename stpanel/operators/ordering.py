"""Ranks and running aggregates that do not put a whole group in one task.

A plain window over one key sorts every row of that key in a single task. Here
the order axis is cut into fixed ranges: each range is reduced to one summary
row, the short summary table is scanned in order, and the carry-in of each range
is joined back. Only one range of one key ever meets in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 65_536  # consecutive order values per range


def _ranged(df: DataFrame, order: str, size: int, part: Column | None = None) -> DataFrame:
    ranges = F.floor(F.col(order) / F.lit(size)) if part is None else part
    return df.withColumn("_range", ranges)


def _earlier(keys: Sequence[str]):
    return (
        Window.partitionBy(*keys)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def with_position(
    df: DataFrame,
    order: str,
    keys: Sequence[str] = (),
    name: str = "pos",
    size: int = RANGE,
    part: Column | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row by the column ``order`` within ``keys``.

    ``order`` must be unique within a key, and keys and order not NULL. Ranges
    hold ``size`` consecutive numbers; for other types pass ``part``, a coarser
    expression that grows with ``order``.
    """
    by = [*keys, "_range"]
    rows = _ranged(df, order, size, part)
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        *by, F.coalesce(F.sum("_n").over(_earlier(keys)), F.lit(0)).alias("_before")
    )
    local = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return (
        rows.withColumn("_local", local)
        .join(before, by)
        .withColumn(name, F.col("_before") + F.col("_local") - 1)
        .drop("_range", "_local", "_before")
    )


def running(
    df: DataFrame,
    order: str,
    outputs: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    inclusive: bool = True,
    size: int = RANGE,
) -> DataFrame:
    """Add running minima or maxima along ``order`` within ``keys``.

    ``outputs`` maps a new column to ``("min" | "max", expression)``. With
    ``inclusive=False`` the current row is left out. NULLs are skipped.
    """
    merge: dict[str, tuple[Callable, Callable]] = {
        "min": (F.min, F.least),
        "max": (F.max, F.greatest),
    }
    part = [*keys, "_range"]
    rows = _ranged(df, order, size)
    for name, (_, expr) in outputs.items():
        rows = rows.withColumn(f"_v_{name}", expr)
    summary = rows.groupBy(*part).agg(
        *[merge[kind][0](f"_v_{name}").alias(f"_s_{name}") for name, (kind, _) in outputs.items()]
    )
    carry = summary.select(
        *part,
        *[
            merge[kind][0](f"_s_{name}").over(_earlier(keys)).alias(f"_c_{name}")
            for name, (kind, _) in outputs.items()
        ],
    )
    local = (
        Window.partitionBy(*part)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    rows = rows.select(
        "*",
        *[
            merge[kind][0](f"_v_{name}").over(local).alias(f"_l_{name}")
            for name, (kind, _) in outputs.items()
        ],
    ).join(carry, part)
    keep = [F.col(c) for c in df.columns]
    return rows.select(
        *keep,
        *[
            merge[kind][1](F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name)
            for name, (kind, _) in outputs.items()
        ],
    )
