"""Forecast scores on the persistence forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from stpanel.functions import scores as M
from stpanel.operators import scoring as S
from stpanel.operators.scaling import fit
from stpanel.operators.storage import attach, materialize
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded

KEYS = "sample_id, horizon, node_id"


@query(
    "pred_truth_join",
    """SELECT sample_id, horizon, node_id, pred, "true" FROM predictions
    WHERE (sample_id + horizon + node_id) % 103 <> 0""",
)
def pred_truth_join(spark, sf):
    """Truths come from the panel; some forecasts are missing."""
    forecast, truth = _sides(spark, sf)
    return S.align_forecast(forecast, truth)


@query(
    "pred_truth_report",
    """, sides AS (
      SELECT p.sample_id IS NOT NULL AS f
      FROM (SELECT y.time_step - 6 - h AS sample_id, h AS horizon, y.node_id
            FROM panel y, (SELECT unnest([1, 2, 3, 4]) AS h) WHERE y.time_step - 6 - h >= 0) t
      LEFT JOIN (SELECT * FROM predictions
                 WHERE (sample_id + horizon + node_id) % 103 <> 0) p
        USING (sample_id, horizon, node_id))
    SELECT count(*) FILTER (f) AS matched, CAST(0 AS BIGINT) AS forecast_only,
           count(*) FILTER (NOT f) AS truth_only FROM sides""",
)
def pred_truth_report(spark, sf):
    return S.alignment_report(*_sides(spark, sf))


def _sides(spark, sf):
    keys = ["sample_id", "horizon", "node_id"]
    dropped = F.pmod(F.col("sample_id") + F.col("horizon") + F.col("node_id"), F.lit(103)) == 0
    forecast = fx.predictions(spark, sf).where(~dropped).select(*keys, "pred")
    horizons = F.explode(F.array(*[F.lit(h) for h in range(1, fx.HORIZON + 1)]))
    truth = (
        fx.panel(spark, sf)
        .select("time_step", "node_id", F.col("f0").alias("true"), horizons.alias("horizon"))
        .select(
            (F.col("time_step") - (fx.LAG - 1) - F.col("horizon")).cast("long").alias("sample_id"),
            "horizon",
            "node_id",
            "true",
        )
        .where("sample_id >= 0")
    )
    return forecast, truth


@query(
    "anomaly",
    f"""SELECT {KEYS}, {r("pred - clim")} AS pred_anom, {r('"true" - clim')} AS true_anom
    FROM predictions JOIN clim USING (node_id)""",
)
def anomaly(spark, sf):
    clim = materialize(fx.train_climatology(spark, sf), "clim")
    return rounded(
        S.anomalies(fx.predictions(spark, sf), clim), ["pred_anom", "true_anom"]
    )


@query(
    "metrics_by_horizon",
    f"""SELECT horizon, {r('avg(abs(pred - "true"))')} AS mae,
           {r('avg((pred - "true") ** 2)')} AS mse,
           {r('sqrt(avg((pred - "true") ** 2))')} AS rmse,
           {r('avg(abs(("true" - pred) / "true")) FILTER ("true" > 0)')} AS mape
    FROM predictions GROUP BY horizon""",
)
def metrics_by_horizon(spark, sf):
    out = S.metrics_by(fx.predictions(spark, sf), ratio_mask=0.0)
    return rounded(out, ["mae", "mse", "rmse", "mape"])


MASKS = {"all": None, "m20": 20.0, "m60": 60.0}


def _masked_sql() -> str:
    parts = []
    for name, m in MASKS.items():
        keep = "" if m is None else f' FILTER ("true" > {m})'
        parts.append(r(f'avg(abs(pred - "true")){keep}') + f" AS mae_{name}")
        parts.append(r(f'sqrt(avg((pred - "true") ** 2){keep})') + f" AS rmse_{name}")
    return f"SELECT horizon, {', '.join(parts)} FROM predictions GROUP BY horizon"


@query("masked_metrics", _masked_sql())
def masked_metrics(spark, sf):
    """Several masks in one pass."""
    aggs = [
        score(mask=m).alias(f"{score.__name__}_{name}")
        for name, m in MASKS.items()
        for score in (M.mae, M.rmse)
    ]
    out = fx.predictions(spark, sf).groupBy("horizon").agg(*aggs)
    return rounded(out, [c for c in out.columns if c != "horizon"])


ZERO_KEEP = "CASE WHEN true2 <> 0 THEN pred2 - true2 END"


@query(
    "nonzero_mae_rmse",
    f"""SELECT count({ZERO_KEEP}) AS n_kept, {r(f"avg(abs({ZERO_KEEP}))")} AS mae,
           {r(f"sqrt(avg(({ZERO_KEEP}) ** 2))")} AS rmse FROM predictions""",
)
def nonzero_mae_rmse(spark, sf):
    """On the counter feature, which has zeros."""
    return rounded(S.nonzero_scores(fx.predictions(spark, sf, "f2")), ["mae", "rmse"])


@query(
    "metric_rrse",
    f"""SELECT horizon,
           {r('sqrt(sum((pred - "true") ** 2)) / sqrt(sum(("true" - m) ** 2))')} AS rrse,
           {r('sqrt(sum((pred - "true") ** 2)) / sqrt(sum((pred - m) ** 2))')} AS rrse_forecast,
           {r('sqrt(sum((pred - "true") ** 2) FILTER ("true" > 20))'
              ' / sqrt(sum(("true" - m20) ** 2) FILTER ("true" > 20))')} AS rrse_m20
    FROM (SELECT *, avg("true") OVER (PARTITION BY horizon) AS m,
                 avg(CASE WHEN "true" > 20 THEN "true" END) OVER (PARTITION BY horizon) AS m20
          FROM predictions) GROUP BY horizon""",
)
def metric_rrse(spark, sf):
    out = fx.predictions(spark, sf).groupBy("horizon").agg(
        M.rrse().alias("rrse"),
        M.rrse(variant="forecast").alias("rrse_forecast"),
        M.rrse(mask=20.0).alias("rrse_m20"),
    )
    return rounded(out, ["rrse", "rrse_forecast", "rrse_m20"])


CORR_SQL = """(SELECT horizon, node_id, covar_pop(pred, "true") AS c, stddev_pop(pred) AS p0,
                      stddev_pop("true") AS t0, stddev_samp(pred) AS p1, stddev_samp("true") AS t1
               FROM predictions GROUP BY horizon, node_id)"""


@query(
    "metric_corr",
    f"""SELECT horizon, {r("avg(c / (p0 * t0)) FILTER (t0 <> 0)")} AS corr,
           {r("avg(c / (p1 * t1)) FILTER (t0 <> 0)")} AS corr_sample
    FROM {CORR_SQL} GROUP BY horizon""",
)
def metric_corr(spark, sf):
    moments = S.node_moments(fx.predictions(spark, sf))
    out = moments.groupBy("horizon").agg(
        S.mean_correlation(0).alias("corr"), S.mean_correlation(1).alias("corr_sample")
    )
    return rounded(out, ["corr", "corr_sample"])


@query(
    "metric_bias",
    f"""SELECT horizon, {r('avg(CASE WHEN pred > "true" THEN 1.0 ELSE 0.0 END)')} AS pnbi,
           {r('avg(("true" + pred) / (2 * "true")) FILTER ("true" > 20)')} AS opnbi
    FROM predictions GROUP BY horizon""",
)
def metric_bias(spark, sf):
    out = fx.predictions(spark, sf).groupBy("horizon").agg(
        M.pnbi().alias("pnbi"), M.opnbi(mask=20.0).alias("opnbi")
    )
    return rounded(out, ["pnbi", "opnbi"])


@query(
    "metric_relative",
    f"""SELECT horizon, {r('sum(abs("true" - pred)) / sum("true")')} AS mare,
           {r('avg(abs("true" - pred) / (abs("true") + abs(pred)))')} AS smape
    FROM predictions GROUP BY horizon""",
)
def metric_relative(spark, sf):
    out = fx.predictions(spark, sf).groupBy("horizon").agg(
        M.mare().alias("mare"), M.smape().alias("smape")
    )
    return rounded(out, ["mare", "smape"])


RMSE_W_SQL = """SELECT horizon, sqrt(avg((pred - "true") ** 2 * lat_weight)) AS rmse_w
    FROM predictions JOIN weights USING (node_id) GROUP BY horizon"""


@query("rmse_weighted", f"SELECT horizon, {r('rmse_w')} AS rmse_w FROM ({RMSE_W_SQL})")
def rmse_weighted(spark, sf):
    return rounded(
        S.weighted_rmse(fx.predictions(spark, sf), fx.weights(spark, sf)), ["rmse_w"]
    )


ACC_W_SQL = """SELECT horizon,
      sum(lat_weight * a * b)
        / (sqrt(sum(lat_weight * a * a) * sum(lat_weight * b * b)) + 1e-6) AS acc_w
    FROM (SELECT horizon, lat_weight,
                 pred - clim - avg(pred - clim) OVER (PARTITION BY horizon) AS a,
                 "true" - clim - avg("true" - clim) OVER (PARTITION BY horizon) AS b
          FROM predictions JOIN weights USING (node_id) JOIN clim USING (node_id))
    GROUP BY horizon"""


@query("acc_weighted", f"SELECT horizon, {r('acc_w')} AS acc_w FROM ({ACC_W_SQL})")
def acc_weighted(spark, sf):
    acc = S.weighted_acc(
        fx.predictions(spark, sf), fx.weights(spark, sf), fx.train_climatology(spark, sf)
    )
    return rounded(acc, ["acc_w"])


@query(
    "weighted_average",
    f"""SELECT {r("avg(rmse_w)")} AS avg_rmse_w,
           {r(f"(SELECT avg(acc_w) FROM ({ACC_W_SQL}))")} AS avg_acc_w FROM ({RMSE_W_SQL})""",
)
def weighted_average(spark, sf):
    """Both weighted scores averaged over the horizons, as a run reports them."""
    both = S.weighted_scores(
        fx.predictions(spark, sf), fx.weights(spark, sf), fx.train_climatology(spark, sf)
    )
    return rounded(S.horizon_mean(both, ["rmse_w", "acc_w"]), ["avg_rmse_w", "avg_acc_w"])


@query(
    "metric_bundle",
    f"""SELECT horizon, {r('avg((pred - "true") ** 2) FILTER ("true" > 5)')} AS mse,
           {r('avg(abs(pred - "true")) FILTER ("true" > 5)')} AS mae,
           {r('sqrt(avg((pred - "true") ** 2) FILTER ("true" > 5))')} AS rmse,
           {r('avg(abs(("true" - pred) / "true")) FILTER ("true" > 20)')} AS mape,
           {r('sqrt(sum((pred - "true") ** 2) FILTER ("true" > 5))'
              ' / sqrt(sum(("true" - m) ** 2) FILTER ("true" > 5))')} AS rrse,
           {r("any_value(corr)")} AS corr
    FROM (SELECT *, avg(CASE WHEN "true" > 5 THEN "true" END) OVER (PARTITION BY horizon) AS m
          FROM predictions)
    JOIN (SELECT horizon, avg(c / (p0 * t0)) FILTER (t0 <> 0) AS corr
          FROM {CORR_SQL} GROUP BY horizon) USING (horizon)
    GROUP BY horizon""",
)
def metric_bundle(spark, sf):
    out = S.metric_bundle(fx.predictions(spark, sf), mask=5.0, ratio_mask=20.0)
    return rounded(out, ["mse", "mae", "rmse", "mape", "rrse", "corr"])


@query(
    "metric_pair",
    f"""SELECT horizon,
           {r('sqrt(sum((pred - "true") ** 2)) / sqrt(sum((pred - m) ** 2))')} AS rrse,
           {r("any_value(corr)")} AS corr
    FROM (SELECT *, avg("true") OVER (PARTITION BY horizon) AS m FROM predictions)
    JOIN (SELECT horizon, avg(c / (p1 * t1)) FILTER (t0 <> 0) AS corr
          FROM {CORR_SQL} GROUP BY horizon) USING (horizon)
    GROUP BY horizon""",
)
def metric_pair(spark, sf):
    return rounded(S.metric_pair(fx.predictions(spark, sf)), ["rrse", "corr"])


@query(
    "mae_unscaled",
    f"""SELECT {r('avg(abs(pred - "true")) FILTER ("true" > 20)')} AS mae FROM predictions""",
)
def mae_unscaled(spark, sf):
    """Forecasts are scaled with the statistics of their feature, then restored."""
    scaler = fit(fx.panel(spark, sf), ["f0"], "std", "feature")
    scaled = scaler.transform(
        fx.predictions(spark, sf), {"pred": "f0", "true": "f0"}, suffix=""
    )
    return rounded(S.mae_unscaled(scaled, scaler, "f0", mask=20.0), ["mae"])


@query(
    "pair_disagreement",
    f"""SELECT horizon, {r("avg((pred - clim) ** 2)")} AS disagreement,
           {r('(avg((pred - "true") ** 2) + avg((clim - "true") ** 2)) / 2'
              ' + 9.1 * avg((pred - clim) ** 2)')} AS score
    FROM predictions JOIN clim USING (node_id) GROUP BY horizon""",
)
def pair_disagreement(spark, sf):
    """Persistence against the climatology of the node."""
    clim = materialize(fx.train_climatology(spark, sf), "clim")
    both = attach(fx.predictions(spark, sf), clim, "node_id")
    out = S.pair_disagreement(both, "pred", "clim", beta=9.1, by=["horizon"])
    return rounded(out, ["disagreement", "score"])


OFFSET = 1e6  # geopotential and pressure are stored with offsets of this order


def _offset(spark, sf):
    shift = {c: F.col(c) + F.lit(OFFSET) for c in ("pred", "true")}
    return fx.predictions(spark, sf).withColumns(shift)


@query(
    "offset_scores",
    f"""SELECT horizon, {r("any_value(acc_w)")} AS acc_w,
           {r('sqrt(sum((pred - "true") ** 2)) / sqrt(sum(("true" - m) ** 2))')} AS rrse,
           {r('sqrt(sum((pred - "true") ** 2)) / sqrt(sum((pred - m) ** 2))')} AS rrse_forecast
    FROM (SELECT *, avg("true") OVER (PARTITION BY horizon) AS m FROM predictions)
    JOIN ({ACC_W_SQL}) USING (horizon) GROUP BY horizon""",
)
def offset_scores(spark, sf):
    """Scores that a common offset must not change, on values near a million."""
    rows = _offset(spark, sf)
    acc = S.weighted_acc(rows, fx.weights(spark, sf), fx.train_climatology(spark, sf))
    truth = S.metric_bundle(rows).select("horizon", "rrse")
    pair = S.metric_pair(rows).select("horizon", F.col("rrse").alias("rrse_forecast"))
    out = acc.join(truth, "horizon").join(pair, "horizon")
    return rounded(out, ["acc_w", "rrse", "rrse_forecast"])
