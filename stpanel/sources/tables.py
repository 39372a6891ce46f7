"""Named inputs, dimension tables and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.operators.panel import NODE, TIME, in_tensor_order
from stpanel.sources.appends import append_once
from stpanel.sources.npy import register

# Names of the known datasets and the files to try for each, in
# order. The last one prefers the preprocessed file over the raw one.
DATASETS = {
    "LA": ["X_LA"],
    "SD": ["X_SD"],
    "NOAA": ["X_NOAA"],
    "GIS": ["X_GIS_spark", "X_GIS"],
}

SUFFIXES = {"npy": ".npy", "parquet": ".parquet"}


def _not_found(error: PySparkException) -> bool:
    """Whether the file is absent, by Spark's error class or the Python source's own."""
    condition = error.getCondition() or ""
    python = "\nFileNotFoundError: " in str(error) and condition.startswith("PYTHON_DATA_SOURCE")
    return condition == "PATH_NOT_FOUND" or python


def resolve_source(
    spark: SparkSession,
    name: str,
    root: str,
    datasets: Mapping[str, Sequence[str]] = DATASETS,
    formats: Sequence[str] = ("npy", "parquet"),
) -> DataFrame:
    """Read a dataset by name: the first file of its list that exists."""
    if name not in datasets:
        raise ValueError(f"unknown dataset: {name!r}")
    if "npy" in formats:
        register(spark)
    for stem in datasets[name]:
        for fmt in formats:
            try:
                return spark.read.format(fmt).load(f"{root}/{stem}{SUFFIXES[fmt]}")
            except AnalysisException as error:
                if not _not_found(error):
                    raise
    raise FileNotFoundError(f"no file for dataset {name!r} below {root}")


def load_time_dim(rows: DataFrame, step: str, coord: str) -> DataFrame:
    """Time dimension ``(time_step, coord)`` from any step and time columns."""
    return rows.select(
        F.col(step).cast("long").alias(TIME), F.col(coord).cast("timestamp_ntz").alias("coord")
    )


def load_node_dim(rows: DataFrame, node: str, lat: str, lon: str | None = None) -> DataFrame:
    """Node dimension ``(node_id, lat[, lon])``."""
    places = {"lat": lat} | ({"lon": lon} if lon else {})
    return rows.select(
        F.col(node).cast("int").alias(NODE),
        *[F.col(c).cast("double").alias(name) for name, c in places.items()],
    )


def load_edges(rows: DataFrame, src: str, dst: str) -> DataFrame:
    """Edge list ``(src, dst)``; repeated edges are kept."""
    return rows.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"))


def write_panel(
    panel: DataFrame, path: str, bucket: int | None = None, tile: int = 4096
) -> None:
    """Overwrite a Parquet panel, ordered by time inside each file.

    With ``bucket``, steps are also stored in folders of that many steps, so a
    filter on ``time_bucket`` skips whole folders and one on ``time_step`` skips
    row groups. Tasks get tiles of one bucket and ``tile`` nodes, which bounds
    their rows whatever the number of steps or nodes.
    """
    if bucket is None:
        panel.write.mode("overwrite").parquet(path)
        return
    rows = panel.withColumn("time_bucket", F.floor(F.col(TIME) / F.lit(bucket)))
    (
        rows.repartition(F.col("time_bucket"), F.floor(F.col(NODE) / F.lit(tile)))
        .sortWithinPartitions("time_bucket", TIME, NODE)
        .write.mode("overwrite")
        .partitionBy("time_bucket")
        .parquet(path)
    )


def export_tensor(
    panel: DataFrame, features: Sequence[str], path: str, steps: int, nodes: int
) -> None:
    """Write the tensor as rows: one FLOAT array over features per step and node.

    Cells are in row-major order, so the files read in name order are the tensor.
    """
    cell = F.array(*[F.col(c).cast("float") for c in features])
    rows = in_tensor_order(panel.select(TIME, NODE, cell.alias("cell")), steps, nodes)
    rows.write.mode("overwrite").parquet(path)


def read_tensor(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """Panel of FLOAT features from an exported tensor."""
    return spark.read.parquet(path).select(
        TIME, NODE, *[F.col("cell")[i].alias(c) for i, c in enumerate(features)]
    )


def max_abs_difference(before: DataFrame, after: DataFrame, features: Sequence[str]) -> DataFrame:
    """Largest absolute difference per feature over matching cells, NaN ignored.

    Also counts the cells that only one side has.
    """
    a = before.select(TIME, NODE, F.struct(*features).alias("_a"))
    b = after.select(TIME, NODE, F.struct(*features).alias("_b"))
    both = a.join(b, [TIME, NODE], "full")
    gaps = {c: F.abs(F.col(f"_a.{c}") - F.col(f"_b.{c}")) for c in features}
    return both.agg(
        *[F.max(F.when(~F.isnan(gap), gap)).alias(f"diff_{c}") for c, gap in gaps.items()],
        F.count(F.when(F.col("_a").isNull() | F.col("_b").isNull(), 1)).alias("unmatched"),
    )


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Forecasts and truths, keyed by sample, horizon and node."""
    predictions.write.mode("overwrite").parquet(path)


def append_predictions(predictions: DataFrame, path: str, batch: str) -> bool:
    """Add the forecasts of one run; a batch that is there already adds nothing."""
    return append_once(predictions, path, batch)


def append_journal(metrics: DataFrame, path: str, batch: str | None = None) -> bool:
    """Append metric rows with the time of writing.

    With a ``batch`` id the append may be repeated: the batch counts once, and the
    journal is read with ``read_appends``. Without, every call adds its rows.
    """
    rows = metrics.withColumn("logged_at", F.current_timestamp())
    if batch is not None:
        return append_once(rows, path, batch)
    rows.write.mode("append").parquet(path)
    return True
