"""Train/validation/test splits over the time dimension, and time features.

Splits label time steps, not panel rows: the labelled dimension is joined to the
panel where it is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.operators.bitmaps import count_distinct
from stpanel.operators.ordering import with_position
from stpanel.operators.panel import TIME, flat_range
from stpanel.operators.storage import attach, materialize

SPLITS = ("train", "val", "test")

# Half-open [from, to) bounds of the default calendar split.
CALENDAR = {
    "train": ("2006-01-01", "2016-01-01"),
    "val": ("2016-01-01", "2017-01-01"),
    "test": ("2017-01-01", "2019-01-01"),
}


def split_label(coord: str, bounds: Mapping[str, tuple[str, str]] = CALENDAR) -> Column:
    """Split of a time coordinate, NULL outside all (non-overlapping) bounds."""
    at = F.col(coord)
    label = None
    for name, (start, end) in bounds.items():
        inside = (at >= F.to_timestamp_ntz(F.lit(f"{start} 00:00:00"))) & (
            at < F.to_timestamp_ntz(F.lit(f"{end} 00:00:00"))
        )
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


def split_calendar(
    time_dim: DataFrame, bounds: Mapping[str, tuple[str, str]] = CALENDAR, coord: str = "coord"
) -> DataFrame:
    """Label steps by calendar bounds; steps outside all bounds are left out."""
    return time_dim.withColumn("split", split_label(coord, bounds)).where("split IS NOT NULL")


def _split_tail(time_dim: DataFrame, tail: Column, test: Column) -> DataFrame:
    """The last ``test`` steps test, the others of the last ``tail`` validate."""
    total = time_dim.agg(F.count(F.lit(1))).scalar()
    rows = with_position(time_dim, TIME, name="_pos").withColumn("_n", total)
    label = (
        F.when(F.col("_pos") < F.col("_n") - tail, "train")
        .when(F.col("_pos") < F.col("_n") - test, "val")
        .otherwise("test")
    )
    return rows.withColumn("split", label).drop("_pos", "_n")


def split_numbers(time_dim: DataFrame, val: float, test: float) -> DataFrame:
    """Split by step counts, taken from the end and truncated to integers.

    A size of 0 gives an empty split. (A slice with a negative zero bound, the
    array idiom, would return every row instead.)
    """
    return _split_tail(time_dim, F.lit(int(test + val)), F.lit(int(test)))


def split_days(time_dim: DataFrame, val_days: int, test_days: int, interval: int = 60) -> DataFrame:
    """Split by days from the end, at ``interval`` minutes per step."""
    per_day = int(24 * 60 / interval)
    return split_numbers(time_dim, per_day * val_days, per_day * test_days)


def split_ratio(time_dim: DataFrame, val_ratio: float, test_ratio: float) -> DataFrame:
    """Split by shares of the steps, taken from the end and truncated."""
    n = F.col("_n")
    return _split_tail(
        time_dim,
        F.floor(n * F.lit(test_ratio + val_ratio)),
        F.floor(n * F.lit(float(test_ratio))),
    )


def split_sizes(split_dim: DataFrame, lag: int, horizon: int) -> DataFrame:
    """Steps and complete windows per split; a split without steps counts 0."""
    spark = split_dim.sparkSession
    frame = spark.range(len(SPLITS)).select(
        F.element_at(F.array(*map(F.lit, SPLITS)), (F.col("id") + 1).cast("int")).alias("split")
    )
    steps = count_distinct(split_dim, TIME, ["split"], "_n")
    n = F.coalesce("_n", F.lit(0))
    return frame.join(steps, "split", "left").select(
        "split",
        n.alias("n_steps"),
        F.greatest(n - (lag + horizon - 1), F.lit(0)).alias("n_windows"),
    )


def step_runs(split_dim: DataFrame) -> dict[str, tuple[int, int]] | None:
    """First and last step of each split, or None if a split has gaps."""
    ends = split_dim.groupBy("split").agg(
        F.min(TIME).alias("start"), F.max(TIME).alias("end"), F.countDistinct(TIME).alias("n")
    )
    rows = ends.collect()  # one row per split
    if any(row["end"] - row["start"] + 1 != row["n"] for row in rows):
        return None
    return {row["split"]: (row["start"], row["end"]) for row in rows}


def split_rows(
    panel: DataFrame, split_dim: DataFrame, split: str, flat: tuple[str, int] | None = None
) -> DataFrame:
    """Panel rows of one split: a range filter on the step if the split has no gaps.

    A panel that is computed from a flat index cannot pass a filter on its step
    to the scan. Keep the index as a column and name it, with the number of
    nodes, as ``flat``: the same range then bounds the index.
    """
    steps = split_dim.where(F.col("split") == split).select(TIME, "split")
    runs = step_runs(steps)
    if runs is None:
        return attach(panel, materialize(steps.select(TIME), "steps"), TIME, "left_semi")
    if split not in runs:
        return panel.where(F.lit(False))
    if flat is not None:
        return panel.where(flat_range(*flat, *runs[split]))
    return panel.where(F.col(TIME).between(*runs[split]))


def require_splits(split_dim: DataFrame) -> None:
    """Raise if both the training and the test split are empty; others may be."""
    if split_dim.where(F.col("split").isin("train", "test")).isEmpty():
        raise ValueError("no training and no test steps; check the time bounds")


def tod_feature(df: DataFrame, coord: str = "coord", name: str = "tod") -> DataFrame:
    """Six-hour slot of the day scaled to [0, 1]; the same for all nodes."""
    return df.withColumn(name, F.floor(F.hour(coord) / 6) / F.lit(3.0))
