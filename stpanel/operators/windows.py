"""Lag/horizon samples and mini-batches.

A sample is ``lag`` consecutive input steps and the ``horizon`` steps after them,
per node, within one split. Series are cut into overlapping ranges of positions:
each row goes to its own range, and the first rows of a range also go to the
range before. A range becomes one sorted array, from which samples are cut by position: the
plan has the same size for any lag and any number of features. A task then meets
one range of one node, however long the series, and rows are copied
``1 + (lag + horizon) / size`` times rather than once per window they belong to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.operators.ordering import with_position
from stpanel.operators.panel import NODE, TIME
from stpanel.operators.splits import step_runs
from stpanel.operators.storage import attach, materialize

WINDOW_RANGE = 1024  # positions in a range


def split_panel(panel: DataFrame, split_dim: DataFrame) -> DataFrame:
    """Panel rows of the labelled steps, with ``split`` and ``pos`` within it.

    If every split is a gapless run of steps, label and position are arithmetic
    on the step and the step bounds reach the scan. Otherwise the ranked steps
    are stored and looked up.
    """
    runs = step_runs(split_dim)
    if runs is None:
        steps = with_position(split_dim.select(TIME, "split"), TIME, ["split"])
        return attach(panel, materialize(steps, "steps"), TIME)
    step, label, first, kept = F.col(TIME), F.lit(None), F.lit(None), F.lit(False)
    for split, (start, end) in runs.items():
        inside = step.between(start, end)
        kept = kept | inside
        label = F.when(inside, split).otherwise(label)
        first = F.when(inside, start).otherwise(first)
    return panel.where(kept).withColumns(
        {"split": label.cast("string"), "pos": (step - first).cast("long")}
    )


def sliding_windows(
    panel: DataFrame,
    lag: int,
    horizon: int,
    inputs: Sequence[str],
    targets: Sequence[str],
    keys: Sequence[str] = ("split", NODE),
    pos: str = "pos",
    single: bool = False,
    size: int = WINDOW_RANGE,
) -> DataFrame:
    """Samples as ``x: array<struct<inputs>>`` and ``y: array<struct<targets>>``.

    ``sample_id`` is the position of the first input step. With ``single=True``
    ``y`` holds only the last horizon step. Stride is 1, and a sample exists only
    if every one of its steps does. Positions must be unique within ``keys``.
    """
    span = lag + horizon
    if lag < 1 or horizon < 1:
        raise ValueError("need lag >= 1 and horizon >= 1")
    size = max(size, span)  # a row serves its own range and the one before at most
    p = F.col(pos).cast("long")
    own = F.floor(p / F.lit(size))
    ranges = F.when(p - own * size < span - 1, F.array(own - 1, own)).otherwise(F.array(own))
    step = F.struct(p.alias("at"), F.struct(*inputs).alias("x"), F.struct(*targets).alias("y"))
    chunks = (
        panel.select(*keys, step.alias("_step"), F.explode(ranges).alias("_range"))
        .groupBy(*keys, "_range")
        .agg(F.sort_array(F.collect_list("_step")).alias("_chunk"))
    )
    chunk = F.col("_chunk")

    def complete(i: Column) -> Column:
        # Positions are unique and ascending, so the last step is span - 1 ahead
        # only if none is missing. Rows copied from the next range begin no sample.
        first = F.get(chunk, i - 1)["at"]
        ends = F.get(chunk, i + (span - 2))["at"] == first + (span - 1)
        return ends & (F.floor(first / F.lit(size)) == F.col("_range"))

    def sample(i: Column) -> Column:
        # Read by position: a slice would unpack the whole chunk for every sample.
        past = F.transform(F.sequence(i - 1, i + (lag - 2)), lambda j: F.get(chunk, j)["x"])
        ahead = F.transform(F.sequence(i + (span - 2 if single else lag - 1), i + (span - 2)), lambda j: F.get(chunk, j)["y"])
        return F.struct(F.get(chunk, i - 1)["at"].alias("sample_id"), past.alias("x"), ahead.alias("y"))

    starts = F.filter(F.sequence(F.lit(1), F.size(chunk)), complete)
    return chunks.select(*keys, F.inline(F.transform(starts, sample)))


def long_inputs(windows: DataFrame, keys: Sequence[str] = ("split", NODE)) -> DataFrame:
    """One row per input step: ``lag_pos`` 0 .. lag-1 and the input columns."""
    return windows.select(*keys, "sample_id", F.posexplode("x").alias("lag_pos", "_s")).select(
        *keys, "sample_id", "lag_pos", "_s.*"
    )


def long_targets(
    windows: DataFrame, keys: Sequence[str] = ("split", NODE), first_horizon: int = 1
) -> DataFrame:
    """One row per target step: ``horizon`` counted from ``first_horizon``."""
    return windows.select(*keys, "sample_id", F.posexplode("y").alias("_h", "_s")).select(
        *keys, "sample_id", (F.col("_h") + first_horizon).alias("horizon"), "_s.*"
    )


def exog_target_windows(
    panel: DataFrame, lag: int, horizon: int, features: Sequence[str], **options
) -> DataFrame:
    """Samples whose inputs leave out the lead feature, which is the only target."""
    return sliding_windows(panel, lag, horizon, features[1:], features[:1], **options)


def lag_vector(windows: DataFrame, inputs: Sequence[str], name: str = "lag_vector") -> DataFrame:
    """Flatten ``x`` to one array per sample and node: time first, then feature."""
    flat = F.flatten(
        F.transform("x", lambda s: F.array(*[s[c].cast("double") for c in inputs]))
    )
    return windows.withColumn(name, flat)


def sample_ids(split_dim: DataFrame, lag: int, horizon: int) -> DataFrame:
    """Ids of the samples of a dense panel, from its labelled steps alone."""
    steps = with_position(split_dim.select(TIME, "split"), TIME, ["split"])
    last = steps.groupBy("split").agg(F.max("pos").alias("_last"))
    return (
        steps.join(last, "split")
        .where(F.col("pos") + (lag + horizon - 1) <= F.col("_last"))
        .select("split", F.col("pos").alias("sample_id"))
    )


def assign_batches(
    samples: DataFrame,
    batch_size: int,
    drop_last: bool = False,
    order: str = "sample_id",
    keys: Sequence[str] = ("split",),
) -> DataFrame:
    """Number mini-batches from a dense 0-based ``order`` column; no sort needed.

    ``drop_last`` leaves out a final batch that is not full.
    """
    out = samples.withColumn("batch_id", F.floor(F.col(order) / F.lit(batch_size)))
    if not drop_last:
        return out
    full = samples.groupBy(*keys).agg(
        F.floor((F.max(order) + 1) / F.lit(batch_size)).alias("_full")
    )
    return out.join(full, [*keys]).where("batch_id < _full").drop("_full")


def batches_per_epoch(batches: DataFrame, keys: Sequence[str] = ("split",)) -> DataFrame:
    return batches.groupBy(*keys).agg(F.countDistinct("batch_id").alias("n_batches"))
