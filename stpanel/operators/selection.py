"""Choosing epochs and runs from a metrics table.

Columns: ``run_id, epoch, train_loss, val_loss, rmse_w, acc_w``; epochs of a run
count from 1 without holes. Running values use range summaries (see
``ordering``), so a run of any length is spread over tasks; they read their
input twice, so pass a stored table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.functions.scalar import is_missing
from stpanel.operators.ordering import running

RUN = "run_id"
EPOCH = "epoch"
DIVERGED = 1e6  # fixed value: a training loss above it ends the run
INF = float("inf")


def _cost(metric: str, best: str) -> Column:
    """Metric as a cost to minimize; NULL where it can never become the best."""
    c = F.col(metric)
    cost = c if best == "min" else -c
    return F.when(~is_missing(c) & (cost < INF), cost)


def best_two_epochs(runs: DataFrame, metric: str, best: str = "min") -> DataFrame:
    """Best and second-best *distinct* value per run, each at its earliest epoch."""
    values = (
        runs.select(RUN, EPOCH, metric, _cost(metric, best).alias("_cost"))
        .where("_cost IS NOT NULL")
        .groupBy(RUN, "_cost")
        .agg(F.min(EPOCH).alias(EPOCH), F.min(metric).alias("value"))
    )
    place = F.row_number().over(Window.partitionBy(RUN).orderBy("_cost"))
    return (
        values.withColumn("place", place).where("place <= 2").select(RUN, "place", "value", EPOCH)
    )


def best_so_far(runs: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Best and second-best distinct value after each epoch, with their epochs.

    ``metrics`` maps a metric to "min" or "max"; all are traced together. A value
    can first rank second in two ways: it is worse than the best so far, or it
    was the best and is replaced. Both are candidates at one known epoch, so the
    second best is a running minimum too.
    """
    entries = {}
    for metric, best in metrics.items():
        cost = _cost(metric, best)
        entries[f"_now_{metric}"] = F.when(
            cost.isNotNull(), F.struct(cost.alias("cost"), F.col(EPOCH).alias("at"))
        )
    rows = runs.select(RUN, EPOCH, *[entry.alias(name) for name, entry in entries.items()])
    earlier = {f"_before_{m}": ("min", F.col(f"_now_{m}")) for m in metrics}
    rows = running(rows, EPOCH, earlier, [RUN], inclusive=False)
    upto = {}
    for m in metrics:
        now, before = F.col(f"_now_{m}"), F.col(f"_before_{m}")
        candidate = F.when(now["cost"] < before["cost"], before).when(
            now["cost"] > before["cost"], now
        )
        upto |= {f"_best_{m}": ("min", now), f"_second_{m}": ("min", candidate)}
    rows = running(rows, EPOCH, upto, [RUN])
    out = []
    for m, best in metrics.items():
        sign = 1.0 if best == "min" else -1.0
        for place in ("best", "second"):
            out += [
                (F.col(f"_{place}_{m}.cost") * sign).alias(f"{m}_{place}"),
                F.col(f"_{place}_{m}.at").alias(f"{m}_{place}_epoch"),
            ]
    return rows.select(RUN, EPOCH, *out)


def _losses(runs: DataFrame) -> DataFrame:
    """Loss that steers the run: validation, or training without validation."""
    loss = F.coalesce("val_loss", "train_loss")
    return runs.select(
        RUN,
        EPOCH,
        F.when(~is_missing(loss) & (loss < INF), loss).alias("_loss"),
        (~is_missing("train_loss") & (F.col("train_loss") > DIVERGED)).alias("_diverged"),
    )


def early_stop(runs: DataFrame, patience: int) -> DataFrame:
    """Epoch at which each run ends and why: "diverged", "patience" or "completed".

    A run diverges when its training loss passes the limit, and runs out of
    patience when the last strict improvement is ``patience`` epochs back. At the
    same epoch divergence comes first. ``stop_epoch`` is NULL if neither happens.
    """
    loss = F.col("_loss")
    entry = F.when(loss.isNotNull(), F.struct(loss.alias("loss"), F.col(EPOCH).alias("at")))
    # The last strict improvement is where the lowest loss so far first occurred.
    rows = running(_losses(runs), EPOCH, {"_best": ("min", entry)}, [RUN])
    stalled = F.col(EPOCH) - F.coalesce("_best.at", F.lit(0)) == patience
    ends = rows.groupBy(RUN).agg(
        F.min(F.when(F.col("_diverged"), F.col(EPOCH))).alias("_d"),
        F.min(F.when(stalled, F.col(EPOCH))).alias("_p"),
    )
    reason = (
        F.when(F.col("_d") <= F.coalesce("_p", "_d"), "diverged")
        .when(F.col("_p").isNotNull(), "patience")
        .otherwise("completed")
    )
    return ends.select(RUN, F.least("_d", "_p").alias("stop_epoch"), reason.alias("reason"))


def best_checkpoint(runs: DataFrame, patience: int) -> DataFrame:
    """Epoch whose state is kept: the first lowest loss before the run ends.

    A diverging epoch is never kept. If no loss ever counts, the last epoch run is.
    """
    rows = _losses(runs).join(early_stop(runs, patience), RUN)
    ran = F.col("stop_epoch").isNull() | (F.col(EPOCH) <= F.col("stop_epoch"))
    eligible = ran & ~((F.col("reason") == "diverged") & (F.col(EPOCH) == F.col("stop_epoch")))
    entry = F.when(
        eligible & F.col("_loss").isNotNull(),
        F.struct(F.col("_loss").alias("loss"), F.col(EPOCH).alias("at")),
    )
    return (
        rows.groupBy(RUN)
        .agg(F.min(entry).alias("_best"), F.max(F.when(ran, F.col(EPOCH))).alias("_end"))
        .select(
            RUN,
            F.coalesce("_best.at", "_end").alias("best_epoch"),
            F.col("_best.loss").alias("best_loss"),
        )
    )


def best_trial(runs: DataFrame, metric: str = "rmse_w") -> DataFrame:
    """The run whose best average metric is lowest."""
    return (
        runs.groupBy(RUN)
        .agg(F.min(_cost(metric, "min")).alias("best_value"))
        .where("best_value IS NOT NULL")
        .orderBy("best_value", RUN)
        .limit(1)
    )


def epoch_loss(batches: DataFrame, loss: str = "loss") -> DataFrame:
    """Mean of the batch losses of each epoch; every batch counts the same."""
    return batches.groupBy(RUN, EPOCH).agg(F.avg(loss).alias("train_loss"))
