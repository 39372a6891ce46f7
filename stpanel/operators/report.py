"""Tables behind charts: step series and node grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stpanel.operators.panel import NODE, TIME
from stpanel.operators.sampling import stride_sample
from stpanel.operators.stats import step_evolution
from stpanel.operators.storage import materialize


def step_series(panel: DataFrame, col: str, points: int = 500) -> DataFrame:
    """Average and maximum per step, thinned to about ``points`` steps.

    The steps are stored once: thinning counts and ranks them before it picks.
    """
    return stride_sample(materialize(step_evolution(panel, col), "steps"), points)


def time_slice(panel: DataFrame, step: int, cols: list[str]) -> DataFrame:
    """One step of the panel, ordered by node.

    The filter reaches the scan of a stored panel. For a panel computed from a
    flat index, ask ``flatten`` for the step as well.
    """
    return panel.where(F.col(TIME) == step).select(NODE, *cols).orderBy(NODE)


def grid_shape(node_dim: DataFrame, lat: str | None = "lat") -> DataFrame:
    """Height and width of a row-major grid of nodes, in one row.

    The width is the number of nodes on the first node's latitude if that
    divides the number of nodes; otherwise the grid is as square as possible,
    with the largest divisor up to the square root as height.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    rows = node_dim
    if lat is not None:
        first = node_dim.agg(F.min_by(lat, NODE)).scalar()
        rows = node_dim.withColumn("_first", first)
        aggs.append(F.count(F.when(F.col(lat) == F.col("_first"), 1)).alias("w"))
    else:
        aggs.append(F.lit(0).cast("long").alias("w"))
    root = F.floor(F.sqrt(F.col("n")))
    divisors = F.filter(F.sequence(F.lit(1).cast("long"), root), lambda d: F.col("n") % d == 0)
    by_lat = (F.col("w") > 0) & (F.col("n") % F.greatest("w", F.lit(1)) == 0)
    sizes = rows.agg(*aggs).where("n > 0").withColumn("_h", F.array_max(divisors))
    width = F.when(by_lat, F.col("w")).otherwise((F.col("n") / F.col("_h")).cast("long"))
    return sizes.select(
        (F.col("n") / width).cast("int").alias("height"), width.cast("int").alias("width")
    )


def grid_cells(panel: DataFrame, shape: DataFrame, value: str) -> DataFrame:
    """Node values as grid cells ``(grid_row, grid_col, value)``."""
    width = shape.select("width").scalar()
    rows = panel.withColumn("_w", width)
    return rows.select(
        *[c for c in (TIME,) if c in panel.columns],
        F.floor(F.col(NODE) / F.col("_w")).cast("int").alias("grid_row"),
        F.pmod(F.col(NODE), F.col("_w")).cast("int").alias("grid_col"),
        F.col(value).alias("value"),
    )


def grid_heatmap(panel: DataFrame, node_dim: DataFrame, value: str) -> DataFrame:
    """One row per grid row (and step), one column ``c<i>`` per grid column.

    For charts of narrow grids; ``grid_cells`` is the long form for any width.
    Of cells that occur twice the largest value is shown.
    """
    shape = grid_shape(node_dim)
    width = shape.first()["width"]
    cells = grid_cells(panel, shape, value)
    keys = [c for c in (TIME, "grid_row") if c in cells.columns]
    names = [f"c{i}" for i in range(width)]
    return (
        cells.withColumn("_name", F.concat(F.lit("c"), F.col("grid_col")))
        .groupBy(*keys)
        .pivot("_name", names)
        .agg(F.max("value"))
    )
