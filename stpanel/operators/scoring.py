"""Forecast evaluation over a ``predictions`` table.

Columns: ``sample_id, horizon, node_id, pred, true``. Scores that need node
weights, climatology or per-node correlation first shrink the predictions to one
row of central moments per (horizon, node); node tables are joined to that short
table, never to the predictions. Constant shifts per node leave variances and
covariances unchanged, so anomalies need no pass of their own. Means are taken
off before anything is squared, in a second look at the short, stored table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.functions import scores
from stpanel.functions.scalar import NAN, ieee_div
from stpanel.functions.scores import PRED, TRUE, kept
from stpanel.operators.panel import NODE
from stpanel.operators.scaling import Scaler
from stpanel.operators.storage import attach, materialize

BY = ("horizon",)


def align_forecast(
    forecast: DataFrame,
    truth: DataFrame,
    on: Sequence[str] = ("sample_id", "horizon", NODE),
) -> DataFrame:
    """Join forecast (``pred``) and truth (``true``) on their keys."""
    return forecast.join(truth, list(on))


def alignment_report(
    forecast: DataFrame,
    truth: DataFrame,
    on: Sequence[str] = ("sample_id", "horizon", NODE),
) -> DataFrame:
    """Numbers of matched and unmatched rows of both sides, in one row."""
    left = forecast.select(*on, F.lit(True).alias("_f"))
    right = truth.select(*on, F.lit(True).alias("_t"))
    both = left.join(right, list(on), "full")
    has_f, has_t = F.col("_f").isNotNull(), F.col("_t").isNotNull()
    return both.agg(
        F.count(F.when(has_f & has_t, 1)).alias("matched"),
        F.count(F.when(has_f & ~has_t, 1)).alias("forecast_only"),
        F.count(F.when(~has_f & has_t, 1)).alias("truth_only"),
    )


def node_moments(
    predictions: DataFrame, by: Sequence[str] = BY, node: str = NODE, mask: float | None = None
) -> DataFrame:
    """Central moments of forecast and truth per group and node."""
    return predictions.groupBy(*by, node).agg(*_moment_aggs(mask))


def _moment_aggs(mask: float | None, prefix: str = "") -> list[Column]:
    p = kept(F.col(PRED), F.col(TRUE), mask)
    y = kept(F.col(TRUE), F.col(TRUE), mask)
    err = p - y
    made = {
        "n": F.count(y).cast("double"),
        "mean_p": F.avg(p),
        "mean_y": F.avg(y),
        "var_p": F.var_pop(p),
        "var_y": F.var_pop(y),
        "cov": F.covar_pop(p, y),
        "sum_abs": F.sum(F.abs(err)),
        "sum_sq": F.sum(err * err),
    }
    return [c.alias(prefix + name) for name, c in made.items()]


def _node_correlation(ddof: int) -> Column:
    """Population covariance over the product of the two deviations."""
    n = F.col("n")
    # A sample deviation does not exist for one row.
    grow = n / F.when(n > ddof, n - ddof) if ddof else F.lit(1.0)
    spread = F.sqrt(F.col("var_p") * grow) * F.sqrt(F.col("var_y") * grow)
    return F.coalesce(ieee_div(F.col("cov"), spread), F.lit(NAN))


def mean_correlation(ddof: int = 0) -> Column:
    """Aggregate over ``node_moments`` rows; nodes with constant truth are skipped.

    ``ddof=0`` is Pearson's. ``ddof=1`` divides the population covariance by
    sample deviations, which is ``(n - 1) / n`` of it.
    """
    varying = (F.col("var_y") != 0) & (F.col("n") > 0)
    return F.avg(F.when(varying, _node_correlation(ddof)))


def correlation(
    predictions: DataFrame, by: Sequence[str] = BY, node: str = NODE, ddof: int = 0
) -> DataFrame:
    """Mean over nodes of the per-node correlation."""
    return (
        node_moments(predictions, by, node).groupBy(*by).agg(mean_correlation(ddof).alias("corr"))
    )


def require_nodes(cells: DataFrame, lookups: Sequence[tuple[DataFrame, str]], node: str = NODE) -> None:
    """Raise unless each node of ``cells`` has one row with a value in every ``(table, column)``.

    ``cells`` is a short table, a row per group and node. A score over the nodes
    that happen to match would look complete, and a node that is listed twice
    would weigh twice, so both are refused.
    """
    nodes = cells.select(node).distinct()
    for table, column in lookups:
        rows = table.groupBy(node).agg(F.count(F.lit(1)).alias("_rows"), F.count(column).alias("_values"))
        found = nodes.join(rows, node, "left")
        absent = F.coalesce("_values", F.lit(0)) == 0
        flaws = found.agg(
            F.count_if(absent), F.min(F.when(absent, F.col(node))),
            F.count_if(F.col("_rows") > 1), F.min(F.when(F.col("_rows") > 1, F.col(node))),
        ).first()
        for count, first, what in ((*flaws[:2], f"without {column}"), (*flaws[2:], f"with several rows for {column}")):
            if count:
                raise ValueError(f"{count} nodes {what}, e.g. {first}")


def _moments_with(
    predictions: DataFrame, lookups: Sequence[tuple[DataFrame, str]], by: Sequence[str], node: str
) -> DataFrame:
    """Stored moments with the node columns of ``lookups``; all nodes must have them."""
    cells = materialize(node_moments(predictions, by, node), "moments")
    require_nodes(cells, lookups, node)
    for table, column in lookups:
        cells = cells.join(table.select(node, column), node)
    return cells


def _centred(
    cells: DataFrame, by: Sequence[str], columns: Mapping[str, str], n: Column
) -> DataFrame:
    """Add ``<column>_c``: each column minus the mean over its group of another.

    The means come from a first aggregate of the short table; only differences
    from them are squared later.
    """
    means = cells.groupBy(*by).agg(
        *[F.try_divide(F.sum(n * F.col(m)), F.sum(n)).alias(f"_mean_{c}") for c, m in columns.items()]
    )
    rows = cells.join(means, [*by]) if by else cells.crossJoin(means)
    return rows.withColumns({f"{c}_c": F.col(c) - F.col(f"_mean_{c}") for c in columns})


def _rmse_w(weight: Column) -> Column:
    return F.sqrt(F.sum(F.col("sum_sq") * weight) / F.sum("n"))


def weighted_rmse(
    predictions: DataFrame,
    weights: DataFrame,
    by: Sequence[str] = BY,
    node: str = NODE,
    weight: str = "lat_weight",
) -> DataFrame:
    """Root of the mean of weighted squared errors per group; every node needs a weight."""
    cells = _moments_with(predictions, [(weights, weight)], by, node)
    return cells.groupBy(*by).agg(_rmse_w(F.col(weight)).alias("rmse_w"))


def weighted_scores(
    predictions: DataFrame,
    weights: DataFrame,
    climatology: DataFrame,
    by: Sequence[str] = BY,
    node: str = NODE,
    weight: str = "lat_weight",
    clim: str = "clim",
) -> DataFrame:
    """Weighted RMSE and weighted anomaly correlation per group.

    The predictions are read once and shrink to stored moments per group and
    node. Anomalies from the node climatology are centred on their unweighted
    mean over the group before anything is squared, so a large common offset
    costs no digits; the weights enter the sums only. Every node of the
    predictions needs a weight and a climatology (see ``require_nodes``).
    """
    n, w = F.col("n"), F.col(weight)
    cells = _moments_with(predictions, [(weights, weight), (climatology, clim)], by, node)
    cells = cells.withColumns({"_a": F.col("mean_p") - F.col(clim), "_b": F.col("mean_y") - F.col(clim)})
    centred = _centred(cells, by, {"_a": "_a", "_b": "_b"}, n)
    wn, a, b = w * n, F.col("_a_c"), F.col("_b_c")
    cross = F.sum(wn * (F.col("cov") + a * b))
    own_a = F.sum(wn * (F.col("var_p") + a * a))
    own_b = F.sum(wn * (F.col("var_y") + b * b))
    # Fixed value: 1e-6 keeps the quotient finite for constant anomalies.
    acc = cross / (F.sqrt(own_a * own_b) + 1e-6)
    return centred.groupBy(*by).agg(_rmse_w(w).alias("rmse_w"), acc.alias("acc_w"))


def weighted_acc(predictions: DataFrame, weights: DataFrame, climatology: DataFrame, **options):
    """The anomaly correlation of ``weighted_scores`` alone."""
    return weighted_scores(predictions, weights, climatology, **options).drop("rmse_w")


def horizon_mean(scores_by_horizon: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Averages of per-horizon scores, as reported for a run."""
    return scores_by_horizon.agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def metrics_by(
    predictions: DataFrame, by: Sequence[str] = BY, mask: float | None = None,
    ratio_mask: float | None = None,
) -> DataFrame:
    """MAE, MSE, RMSE under ``mask`` and MAPE under ``ratio_mask``, per group."""
    return predictions.groupBy(*by).agg(
        scores.mae(mask=mask).alias("mae"),
        scores.mse(mask=mask).alias("mse"),
        scores.rmse(mask=mask).alias("rmse"),
        scores.mape(mask=ratio_mask).alias("mape"),
    )


def metric_bundle(
    predictions: DataFrame,
    mask: float | None = None,
    ratio_mask: float | None = None,
    by: Sequence[str] = BY,
    node: str = NODE,
    variant: str = "truth",
    ddof: int = 0,
) -> DataFrame:
    """MSE, MAE, RMSE, RRSE under ``mask``, MAPE under ``ratio_mask``, and CORR.

    Correlation takes all rows, whatever the masks. The predictions are read and
    shuffled once, reduced to moments per group and node; the rest is arithmetic
    on that short table.
    """
    y = F.col(TRUE)
    ratio = kept(F.abs(ieee_div(y - F.col(PRED), y)), y, ratio_mask)
    cells = predictions.groupBy(*by, node).agg(
        *_moment_aggs(None),
        *_moment_aggs(mask, "k_"),
        F.sum(ratio).alias("sum_ratio"),
        F.count(ratio).alias("n_ratio"),
    )
    n = F.sum("k_n")
    mse = F.try_divide(F.sum("k_sum_sq"), n)
    return _rrse_cells(cells, by, variant, "k_").groupBy(*by).agg(
        mse.alias("mse"),
        F.try_divide(F.sum("k_sum_abs"), n).alias("mae"),
        F.sqrt(mse).alias("rmse"),
        F.try_divide(F.sum("sum_ratio"), F.sum("n_ratio")).alias("mape"),
        _pooled_rrse(variant, "k_").alias("rrse"),
        mean_correlation(ddof).alias("corr"),
    )


def _rrse_cells(cells: DataFrame, by: Sequence[str], variant: str, prefix: str) -> DataFrame:
    """Stored moments with the node means centred on the mean truth of their group."""
    x = {"truth": f"{prefix}mean_y", "forecast": f"{prefix}mean_p"}[variant]
    stored = materialize(cells, "moments").withColumn("_x", F.col(x))
    return _centred(stored, by, {"_x": f"{prefix}mean_y"}, F.col(f"{prefix}n"))


def _pooled_rrse(variant: str, prefix: str = "") -> Column:
    """RRSE over ``_rrse_cells``: the spread within nodes plus that between them."""
    n, y = F.col(f"{prefix}n"), F.col(f"{prefix}mean_y")
    within = F.sum(n * F.col(f"{prefix}var_{'y' if variant == 'truth' else 'p'}"))
    between = F.sum(n * F.col("_x_c") * F.col("_x_c"))
    if variant == "truth":
        # Equal node means differ from their average by rounding only.
        between = F.when(F.min(y) == F.max(y), F.lit(0.0)).otherwise(between)
    return ieee_div(F.sqrt(F.sum(f"{prefix}sum_sq")), F.sqrt(within + F.coalesce(between, F.lit(0.0))))


def metric_pair(
    predictions: DataFrame, mask: float | None = None, by: Sequence[str] = BY, node: str = NODE
) -> DataFrame:
    """RRSE with the spread of the forecast, and CORR with sample deviations."""
    cells = predictions.groupBy(*by, node).agg(*_moment_aggs(None), *_moment_aggs(mask, "k_"))
    return _rrse_cells(cells, by, "forecast", "k_").groupBy(*by).agg(
        _pooled_rrse("forecast", "k_").alias("rrse"), mean_correlation(1).alias("corr")
    )


def nonzero_scores(predictions: DataFrame) -> DataFrame:
    """MAE and RMSE over all rows with a non-zero truth; NULL if there is none."""
    err = F.when(F.col(TRUE) != 0, F.col(PRED) - F.col(TRUE))
    return predictions.agg(
        F.count(err).alias("n_kept"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def mae_unscaled(
    predictions: DataFrame, scaler: Scaler, target: str, mask: float | None = 0.0
) -> DataFrame:
    """Masked MAE in physical units of forecasts and truths that are scaled."""
    physical = scaler.inverse(predictions, {PRED: target, TRUE: target})
    return physical.agg(scores.mae(mask=mask).alias("mae"))


def pair_disagreement(
    predictions: DataFrame, first: str, second: str, true: str = TRUE, beta: float = 1.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """How far two forecasts differ, and a score that adds it to their mean MSE."""
    gap = F.avg((F.col(first) - F.col(second)) * (F.col(first) - F.col(second)))
    fit = (scores.mse(first, true) + scores.mse(second, true)) / 2.0
    return predictions.groupBy(*by).agg(
        gap.alias("disagreement"), (fit + F.lit(float(beta)) * gap).alias("score")
    )


def anomalies(predictions: DataFrame, climatology: DataFrame, clim: str = "clim") -> DataFrame:
    """Forecast and truth as departures from the node's climatology.

    Pass a stored climatology; it is looked up by node (see ``attach``). Rows of
    nodes without a climatology are kept, with NULL anomalies.
    """
    return attach(predictions, climatology.select(NODE, clim), NODE, "left").select(
        *[c for c in predictions.columns if c not in (PRED, TRUE)],
        (F.col(PRED) - F.col(clim)).alias("pred_anom"),
        (F.col(TRUE) - F.col(clim)).alias("true_anom"),
    )
