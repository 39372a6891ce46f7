"""Building panels and checking their shape.

A panel has one row per ``(time_step, node_id)`` and one DOUBLE column per
feature. Time steps count from 0 and are dense, so a step is also a position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from stpanel.operators.bitmaps import BITS, bit_range, bitmaps, extent, members_without
from stpanel.operators.storage import attach

TIME = "time_step"
NODE = "node_id"


def flat_keys(index: str | Column, n_nodes: int) -> tuple[Column, Column]:
    """Time and node keys of a row-major flat index ``t * n_nodes + n``."""
    i = F.col(index) if isinstance(index, str) else index
    node = F.pmod(i, F.lit(n_nodes))
    step = F.call_function("div", i - node, F.lit(n_nodes))
    return step.cast("long").alias(TIME), node.cast("int").alias(NODE)


def flat_range(index: str, n_nodes: int, first: int, last: int) -> Column:
    """The flat indices of the steps ``first`` to ``last``."""
    return F.col(index).between(first * n_nodes, (last + 1) * n_nodes - 1)


def flatten(
    rows: DataFrame,
    index: str,
    n_nodes: int,
    features: Mapping[str, Column | str],
    keep: Sequence[str] = (),
    steps: tuple[int, int] | None = None,
) -> DataFrame:
    """Panel from rows numbered by a row-major flat index. A plain projection.

    Columns in ``keep`` are passed on as they are. ``steps`` keeps a range of
    steps (both ends included) by bounds on the flat index, which reach the scan;
    a filter on the computed step would not.
    """
    if steps is not None:
        rows = rows.where(flat_range(index, n_nodes, *steps))
    time_step, node_id = flat_keys(index, n_nodes)
    cols = [
        (F.col(c) if isinstance(c, str) else c).cast("double").alias(name)
        for name, c in features.items()
    ]
    return rows.select(time_step, node_id, *cols, *keep)


def in_tensor_order(
    panel: DataFrame, steps: int, nodes: int, rows: int = 4_000_000
) -> DataFrame:
    """Place the cells of a dense panel in row-major order, ``rows`` per partition.

    The place of a cell follows from its key, so no sampling pass is needed,
    partitions are equal, and a retried task gets the same rows.
    """
    index = F.col(TIME) * nodes + F.col(NODE)
    place = F.floor(index / F.lit(rows)).cast("int")
    parts = max(1, -(-steps * nodes // rows))
    return panel.repartitionById(parts, place).sortWithinPartitions(TIME, NODE)


def matrix_to_panel(matrix: DataFrame, time: str, values: str, feature: str = "f0") -> DataFrame:
    """One-feature panel from one row per time step holding an array over nodes."""
    return matrix.select(
        F.col(time).cast("long").alias(TIME), F.posexplode(values).alias(NODE, feature)
    ).withColumn(feature, F.col(feature).cast("double"))


def ingest_frame(spark: SparkSession, frame) -> DataFrame:
    """DataFrame from a pandas frame held by the driver.

    The frame goes through Arrow, which keeps its column types and turns NaN
    into NULL. It has to fit the driver, as it already does; larger inputs are
    read by the array or Parquet source, which never pass through the driver.
    """
    return spark.createDataFrame(pa.Table.from_pandas(frame, preserve_index=False))


def feature_view(
    panel: DataFrame, names: Mapping[str, str], view: str | None = None
) -> DataFrame:
    """Keys plus renamed features (``{feature: new name}``), optionally as a temp view."""
    out = panel.select(TIME, NODE, *[F.col(c).alias(new) for c, new in names.items()])
    if view:
        out.createOrReplaceTempView(view)
    return out


def feature_slice(
    panel: DataFrame, features: Sequence[str], n_input: int, n_output: int
) -> DataFrame:
    """Keys, the first ``n_input`` features, and the first ``n_output`` as ``target_*``."""
    return panel.select(
        TIME,
        NODE,
        *features[:n_input],
        *[F.col(c).alias(f"target_{c}") for c in features[:n_output]],
    )


def time_join(panel: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Add the time coordinate of each step. Every panel row is kept."""
    return attach(panel, time_dim, TIME, "left")


def shape_check(panel: DataFrame, time_dim: DataFrame, node_dim: DataFrame) -> DataFrame:
    """One row comparing the panel's extents with its two dimension tables."""
    sizes = extent(panel, TIME, NODE).withColumnsRenamed({f"n_{TIME}": "n_steps", f"n_{NODE}": "n_nodes"})
    out = sizes.select(
        "*",
        time_dim.agg(F.count(F.lit(1))).scalar().alias("n_coords"),
        node_dim.agg(F.count(F.lit(1))).scalar().alias("n_latitudes"),
    )
    return out.select(
        "*",
        (F.col("n_steps") == F.col("n_coords")).alias("time_ok"),
        (F.col("n_nodes") == F.col("n_latitudes")).alias("nodes_ok"),
        (F.col("n_rows") == F.col("n_steps") * F.col("n_nodes")).alias("dense_ok"),
    )


def require_shapes(panel: DataFrame, time_dim: DataFrame, node_dim: DataFrame) -> None:
    """Raise unless the numbers of steps and nodes match the dimension tables."""
    row = shape_check(panel, time_dim, node_dim).first()
    if not (row["time_ok"] and row["nodes_ok"]):
        raise ValueError(f"panel does not match its dimensions: {row.asDict()}")


def panel_gaps(panel: DataFrame, time_dim: DataFrame, node_dim: DataFrame) -> DataFrame:
    """Every ``(time_step, node_id)`` the dimensions call for and the panel lacks.

    Steps are compared as bitmaps per node and range, so no step-by-node product is
    built row by row; only bytes that differ are taken apart.
    """
    wanted = bitmaps(time_dim, TIME, name="_wanted")
    seen = bitmaps(panel, TIME, [NODE], "_seen")
    ends = time_dim.agg(F.sequence(F.min(bit_range(TIME)), F.max(bit_range(TIME)))).scalar()
    cells = node_dim.select(NODE, F.explode(ends).alias("_range")).join(wanted, "_range")
    differing = cells.join(seen, [NODE, "_range"], "left").where(
        F.col("_seen").isNull() | (F.col("_seen") != F.col("_wanted"))
    )
    absent = members_without(F.col("_wanted"), F.col("_seen"), F.col("_range") * BITS)
    steps = absent.cast(ArrayType(time_dim.schema[TIME].dataType))
    return differing.select(F.explode(steps).alias(TIME), NODE)


def panel_duplicates(panel: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        panel.groupBy(TIME, NODE).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    )
