"""Sources, sinks, projections, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stpanel.operators import panel as P
from stpanel.operators import report, sampling, stats
from stpanel.operators.scaling import fit
from stpanel.operators.splits import split_rows
from stpanel.operators.storage import attach, cached, materialize, scratch_path
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded
from stpanel.sources import blocks, npy, tables
from stpanel.sources.appends import read_appends

PANEL_SQL = "SELECT time_step, node_id, f0, f1, f2, f3 FROM panel"


@query("npy_scan", PANEL_SQL)
def npy_scan(spark, sf):
    panel = fx.panel(spark, sf)
    path = scratch_path(spark, "x") + ".npy"
    npy.write_npy(panel, path, fx.n_steps(panel), fx.N_NODES, dtype="float64")
    return npy.read_npy(spark, path, features="f0,f1,f2,f3")


@query("array_blocks", PANEL_SQL + " WHERE time_step >= 11")
def array_blocks(spark, sf):
    """The panel stored in blocks by Spark's own writer, and read from the twelfth step on."""
    panel = fx.panel(spark, sf)
    path = scratch_path(spark, "blocks")
    blocks.write_blocks(panel, path, fx.n_steps(panel), fx.N_NODES, dtype="float64")
    return blocks.read_blocks(spark, path, start=11)


@query("tensor_flatten", PANEL_SQL)
def tensor_flatten(spark, sf):
    return fx.panel(spark, sf)


@query(
    "matrix_to_panel",
    f"""SELECT CAST(vec_id AS BIGINT) AS time_step, CAST(i AS INTEGER) AS node_id,
           {r("CAST(embedding[i + 1] AS DOUBLE)")} AS f0
    FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)""",
)
def matrix_to_panel(spark, sf):
    return rounded(
        P.matrix_to_panel(fx.table(spark, sf, "embeddings"), "vec_id", "embedding"), ["f0"]
    )


@query(
    "source_fallback",
    """SELECT 'GIS' AS dataset, time_step, node_id, f0 AS x FROM panel
    UNION ALL SELECT 'NOAA', time_step, node_id, f1 FROM panel""",
)
def source_fallback(spark, sf):
    """Two files for one dataset, the preferred one preprocessed; one for another."""
    panel, root = fx.panel(spark, sf), scratch_path(spark, "data")
    files = {"X_GIS": -F.col("f0"), "X_GIS_spark": F.col("f0"), "X_NOAA": F.col("f1")}
    for stem, x in files.items():
        rows = panel.select("time_step", "node_id", x.alias("x"))
        tables.write_panel(rows, f"{root}/{stem}.parquet")
    found = [
        tables.resolve_source(spark, name, root).select(F.lit(name).alias("dataset"), "*")
        for name in ("GIS", "NOAA")
    ]
    return found[0].unionByName(found[1])


@query(
    "frame_ingest",
    f"""SELECT node_id, lat, lon, count(*) AS n_rows, {r("avg(f0)")} AS avg_value
    FROM panel JOIN node_dim USING (node_id) GROUP BY node_id, lat, lon""",
)
def frame_ingest(spark, sf):
    """Node dimension from a driver frame, attached to per-node means of the panel."""
    frame = fx.node_dim(spark, sf).toPandas()
    nodes = P.ingest_frame(spark, frame)
    means = (
        fx.panel(spark, sf)
        .groupBy("node_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("f0"), 6).alias("avg_value"))
    )
    return means.join(nodes, "node_id").select("node_id", "lat", "lon", "n_rows", "avg_value")


ZSCORE_SQL = f"""SELECT time_step, node_id, f0 AS t2m, f1 AS rh,
      {r("(f0 - m0) / s0")} AS t2m_scaled, {r("(f1 - m1) / s1")} AS rh_scaled
    FROM panel, (SELECT avg(f0) AS m0, stddev_samp(f0) AS s0,
                        avg(f1) AS m1, stddev_samp(f1) AS s1 FROM panel)"""


def _scaled(spark, sf):
    view = P.feature_view(fx.panel(spark, sf), {"f0": "t2m", "f1": "rh"})
    return fit(view, ["t2m", "rh"], "std", "feature", ddof=1).transform(view)


@query("zscore_project", ZSCORE_SQL)
def zscore_project(spark, sf):
    return rounded(_scaled(spark, sf), ["t2m_scaled", "rh_scaled"])


@query("parquet_roundtrip", ZSCORE_SQL)
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "scaled")
    tables.write_panel(_scaled(spark, sf), path, bucket=64)
    back = spark.read.parquet(path).drop("time_bucket")
    return rounded(back, ["t2m_scaled", "rh_scaled"])


@query(
    "feature_view",
    "SELECT time_step, node_id, f0 AS t2m, f1 AS t850, f2 AS rh1000, f3 AS q1000 FROM panel",
)
def feature_view(spark, sf):
    names = {"f0": "t2m", "f1": "t850", "f2": "rh1000", "f3": "q1000"}
    P.feature_view(fx.panel(spark, sf), names, view="stpanel_features")
    return spark.sql("SELECT time_step, node_id, t2m, t850, rh1000, q1000 FROM stpanel_features")


@query(
    "tensor_export",
    f"""SELECT time_step, node_id, {r("CAST(CAST(f0 AS FLOAT) AS DOUBLE)")} AS f0,
           {r("CAST(CAST(f1 AS FLOAT) AS DOUBLE)")} AS f1,
           {r("CAST(CAST(f2 AS FLOAT) AS DOUBLE)")} AS f2,
           {r("CAST(CAST(f3 AS FLOAT) AS DOUBLE)")} AS f3 FROM panel""",
)
def tensor_export(spark, sf):
    panel, path = fx.panel(spark, sf), scratch_path(spark, "tensor")
    tables.export_tensor(panel, fx.FEATURES, path, fx.n_steps(panel), fx.N_NODES)
    back = tables.read_tensor(spark, path, fx.FEATURES)
    return back.select(
        "time_step",
        "node_id",
        *[F.round(F.col(c).cast("double"), 6).alias(c) for c in fx.FEATURES],
    )


@query(
    "roundtrip_maxdiff",
    f"""SELECT {r("max(abs(f0 - CAST(CAST(f0 AS FLOAT) AS DOUBLE)))", 9)} AS diff_f0,
           {r("max(abs(f1 - CAST(CAST(f1 AS FLOAT) AS DOUBLE)))", 9)} AS diff_f1,
           {r("max(abs(f2 - CAST(CAST(f2 AS FLOAT) AS DOUBLE)))", 9)} AS diff_f2,
           {r("max(abs(f3 - CAST(CAST(f3 AS FLOAT) AS DOUBLE)))", 9)} AS diff_f3,
           CAST(0 AS BIGINT) AS unmatched FROM panel""",
)
def roundtrip_maxdiff(spark, sf):
    panel, path = fx.panel(spark, sf), scratch_path(spark, "tensor")
    tables.export_tensor(panel, fx.FEATURES, path, fx.n_steps(panel), fx.N_NODES)
    back = tables.read_tensor(spark, path, fx.FEATURES)
    diff = tables.max_abs_difference(panel, back, fx.FEATURES)
    return rounded(diff, [f"diff_{c}" for c in fx.FEATURES], 9)


@query(
    "dim_load",
    """SELECT time_step, node_id, coord, lat, lon, CAST(n_out AS BIGINT) AS n_out
    FROM panel JOIN time_dim USING (time_step) JOIN node_dim USING (node_id)
    JOIN (SELECT src AS node_id, count(*) AS n_out FROM grid_edges GROUP BY src) USING (node_id)""",
)
def dim_load(spark, sf):
    """Time, node and edge dimensions loaded and attached to the panel keys."""
    degrees = (
        fx.grid_edges(spark, sf)
        .groupBy(F.col("src").cast("int").alias("node_id"))
        .agg(F.count(F.lit(1)).alias("n_out"))
    )
    nodes = materialize(fx.node_dim(spark, sf).join(degrees, "node_id"), "nodes")
    rows = P.time_join(
        fx.panel(spark, sf).select("time_step", "node_id"),
        fx.time_dim(spark, sf),
    )
    return attach(rows, nodes, "node_id")


@query(
    "predictions_sink", 'SELECT sample_id, horizon, node_id, pred, "true" FROM predictions'
)
def predictions_sink(spark, sf):
    path = scratch_path(spark, "predictions")
    tables.write_predictions(fx.predictions(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "metrics_journal",
    f"""SELECT run_id, epoch, {r("train_loss")} AS train_loss, rmse_w FROM runs
    UNION ALL SELECT run_id, epoch, {r("train_loss")}, rmse_w FROM runs WHERE rmse_w > 100""",
)
def metrics_journal(spark, sf):
    """Two appends: all epochs, then the epochs with a high error again."""
    path = scratch_path(spark, "journal")
    rows = fx.runs(spark, sf).select("run_id", "epoch", "train_loss", "rmse_w")
    tables.append_journal(rows, path)
    tables.append_journal(rows.where("rmse_w > 100"), path)
    return rounded(spark.read.parquet(path).drop("logged_at"), ["train_loss"])


@query(
    "journal_retry",
    f"SELECT run_id, epoch, {r('train_loss')} AS train_loss, CAST(epoch % 3 AS VARCHAR) AS batch FROM runs",
)
def journal_retry(spark, sf):
    """Three batches, two of them written twice: every row counts once."""
    path = scratch_path(spark, "journal")
    rows = fx.runs(spark, sf).select("run_id", "epoch", "train_loss")
    for batch in (0, 1, 1, 2, 0):
        tables.append_journal(rows.where(F.col("epoch") % 3 == batch), path, str(batch))
    return rounded(read_appends(spark, path).drop("logged_at"), ["train_loss"])


@query("time_slice", "SELECT node_id, f0, f1 FROM panel WHERE time_step = 27")
def time_slice(spark, sf):
    return report.time_slice(fx.panel(spark, sf, steps=(27, 27)), 27, ["f0", "f1"])


@query(
    "feature_slice",
    "SELECT time_step, node_id, f0, f1, f2, f0 AS target_f0 FROM panel",
)
def feature_slice(spark, sf):
    return P.feature_slice(fx.panel(spark, sf), fx.FEATURES, 3, 1)


# --- joins and shape checks ---------------------------------------------------


@query(
    "time_join",
    "SELECT time_step, node_id, f0, coord FROM panel JOIN time_dim USING (time_step)",
)
def time_join(spark, sf):
    dim = fx.time_dim(spark, sf)
    return P.time_join(fx.panel(spark, sf).select("time_step", "node_id", "f0"), dim)


GAPPED = "(SELECT * FROM panel WHERE (time_step * 25 + node_id) % 101 <> 0)"


def _gapped(spark, sf):
    """The panel with holes, so that the check has something to find."""
    flat = F.col("time_step") * fx.N_NODES + F.col("node_id")
    return fx.panel(spark, sf).where(F.pmod(flat, F.lit(101)) != 0)


@query(
    "panel_gaps",
    f"""SELECT time_step, node_id FROM time_dim, node_dim
    EXCEPT SELECT time_step, node_id FROM {GAPPED}""",
)
def panel_gaps(spark, sf):
    dim = fx.time_dim(spark, sf)
    return P.panel_gaps(_gapped(spark, sf), dim, fx.node_dim(spark, sf))


@query(
    "panel_duplicates",
    """SELECT time_step, node_id, CAST(count(*) AS BIGINT) AS copies
    FROM (SELECT CAST(user_id AS INTEGER) AS time_step,
                 CAST(event_id % 25 AS INTEGER) AS node_id FROM events)
    GROUP BY time_step, node_id HAVING count(*) > 1""",
)
def panel_duplicates(spark, sf):
    rows = fx.table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("time_step"),
        F.pmod("event_id", F.lit(25)).cast("int").alias("node_id"),
    )
    return P.panel_duplicates(rows)


@query(
    "shape_check",
    f"""SELECT *, n_steps = n_coords AS time_ok, n_nodes = n_latitudes AS nodes_ok,
           n_rows = n_steps * n_nodes AS dense_ok
    FROM (SELECT count(*) AS n_rows, count(DISTINCT time_step) AS n_steps,
                 count(DISTINCT node_id) AS n_nodes,
                 (SELECT count(*) FROM time_dim) AS n_coords,
                 (SELECT count(*) FROM node_dim) AS n_latitudes FROM {GAPPED})""",
)
def shape_check(spark, sf):
    return P.shape_check(_gapped(spark, sf), fx.time_dim(spark, sf), fx.node_dim(spark, sf))


# --- aggregates ---------------------------------------------------------------


@query(
    "global_stats",
    f"""SELECT {r("avg(f0)")} AS f0_mean, {r("stddev_samp(f0)")} AS f0_std,
           {r("avg(f1)")} AS f1_mean, {r("stddev_samp(f1)")} AS f1_std FROM panel""",
)
def global_stats(spark, sf):
    out = stats.global_stats(fx.panel(spark, sf), ["f0", "f1"])
    return rounded(out, out.columns)


@query(
    "step_evolution",
    f"""SELECT time_step, {r("avg(f1)")} AS avg_value, max(f1) AS max_value
    FROM panel GROUP BY time_step""",
)
def step_evolution(spark, sf):
    out = stats.step_evolution(fx.panel(spark, sf), "f1").orderBy("time_step")
    return rounded(out, ["avg_value"])


@query(
    "step_trend_top5",
    """SELECT time_step, round(avg(f0), 3) AS avg_value, round(max(f0), 3) AS max_value
    FROM panel GROUP BY time_step ORDER BY time_step LIMIT 5""",
)
def step_trend_top5(spark, sf):
    return stats.step_trend(fx.panel(spark, sf), "f0")


@query(
    "missing_audit",
    """, flawed AS (
      SELECT CASE WHEN i % 97 = 0 THEN NULL WHEN i % 89 = 0 THEN CAST('NaN' AS DOUBLE)
                  ELSE f0 END AS f0,
             CASE WHEN i % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE f1 END AS f1, f2
      FROM (SELECT *, time_step * 25 + node_id AS i FROM panel)),
    counts AS (
      SELECT CAST(sum(CASE WHEN f0 IS NULL OR isnan(f0) THEN 1 ELSE 0 END) AS BIGINT) AS a,
             CAST(sum(CASE WHEN f1 IS NULL OR isnan(f1) THEN 1 ELSE 0 END) AS BIGINT) AS b,
             CAST(sum(CASE WHEN f2 IS NULL OR isnan(f2) THEN 1 ELSE 0 END) AS BIGINT) AS c
      FROM flawed)
    SELECT a AS missing_f0, b AS missing_f1, c AS missing_f2, a + b + c AS missing_total
    FROM counts""",
)
def missing_audit(spark, sf):
    i = F.col("time_step") * fx.N_NODES + F.col("node_id")
    nan = F.lit(float("nan"))
    flawed = fx.panel(spark, sf).withColumns(
        {
            "f0": F.when(F.pmod(i, F.lit(97)) != 0, F.when(F.pmod(i, F.lit(89)) == 0, nan)
                         .otherwise(F.col("f0"))),
            "f1": F.when(F.pmod(i, F.lit(83)) == 0, nan).otherwise(F.col("f1")),
        }
    )
    return stats.missing_audit(flawed, ["f0", "f1", "f2"])


@query("row_count", "SELECT count(*) AS n_rows FROM panel")
def row_count(spark, sf):
    return stats.row_count(fx.panel(spark, sf))


@query(
    "partition_counts",
    """, n AS (SELECT count(*) AS n FROM panel)
    SELECT CAST((time_step * 25 + node_id) // ((n + 7) // 8) AS INTEGER) AS partition_id,
           count(*) AS n_rows FROM panel, n GROUP BY 1""",
)
def partition_counts(spark, sf):
    panel = fx.panel(spark, sf)
    return sampling.partition_counts(
        sampling.place_evenly(panel, fx.N_NODES, panel.count(), partitions=8)
    )


@query("cached_fit", ZSCORE_SQL)
def cached_fit(spark, sf):
    """Fits on a cached panel and scales the cached rows: the table is read once."""
    view = P.feature_view(fx.panel(spark, sf), {"f0": "t2m", "f1": "rh"})
    with cached(view) as rows:
        scaler = fit(rows, ["t2m", "rh"], "std", "feature", ddof=1)
        return materialize(rounded(scaler.transform(rows), ["t2m_scaled", "rh_scaled"]), "scaled")


@query(
    "train_fit",
    f"""SELECT time_step, node_id, {r("(f0 - m0) / s0")} AS f0_scaled
    FROM panel, (SELECT avg(f0) AS m0, stddev_pop(f0) AS s0 FROM split_panel
                 WHERE split = 'train')""",
)
def train_fit(spark, sf):
    """Statistics of the training rows, applied to all rows."""
    rows = fx.panel(spark, sf, keep=["event_id"])
    scaler = fit(split_rows(rows, fx.split_dim(spark, sf), "train", fx.FLAT), ["f0"])
    scaled = scaler.transform(fx.panel(spark, sf)).select("time_step", "node_id", "f0_scaled")
    return rounded(scaled, ["f0_scaled"])


@query(
    "panel_profile",
    f""", v AS (SELECT unnest([f0, f1, f2, f3]) AS v FROM panel)
    SELECT count(DISTINCT time_step) AS n_steps, count(DISTINCT node_id) AS n_nodes,
           CAST(4 AS BIGINT) AS n_features, (SELECT max(v) FROM v) AS max_value,
           (SELECT min(v) FROM v) AS min_value,
           {r("(SELECT avg(v) FROM v)", 9)} AS mean_value,
           {r("(SELECT median(v) FROM v)", 9)} AS median_value FROM panel""",
)
def panel_profile(spark, sf):
    out = stats.panel_profile(fx.panel(spark, sf), fx.FEATURES)
    return rounded(out, ["mean_value", "median_value"], 9)


@query("climatology", f"SELECT node_id, {r('clim')} AS clim FROM clim")
def climatology(spark, sf):
    return rounded(fx.train_climatology(spark, sf), ["clim"])


def _hist_sql(x: str, source: str) -> str:
    return f"""SELECT b.bin, {r("lo + b.bin * ((hi - lo) / 60)")} AS left_edge,
             CAST(coalesce(n, 0) AS BIGINT) AS n
      FROM (SELECT CAST(unnest(range(60)) AS INTEGER) AS bin) b
      CROSS JOIN (SELECT min({x}) AS lo, max({x}) AS hi FROM {source})
      LEFT JOIN (
        SELECT least(CAST(floor(60 * ({x} - lo) / (hi - lo)) AS INTEGER), 59) AS bin,
               count(*) AS n
        FROM {source}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {source})
        GROUP BY 1) c ON c.bin = b.bin"""


@query(
    "histogram60",
    f""", scaled AS (
      SELECT f0, (f0 - (SELECT avg(f0) FROM panel)) / (SELECT stddev_samp(f0) FROM panel) AS z
      FROM panel)
    SELECT 'raw' AS series, * FROM ({_hist_sql("f0", "scaled")})
    UNION ALL SELECT 'scaled', * FROM ({_hist_sql("round(z, 9)", "scaled")})""",
)
def histogram60(spark, sf):
    """The value before and after scaling; scaled values are rounded so that
    both engines see the same bin edges."""
    return _histograms(P.feature_view(fx.panel(spark, sf), {"f0": "x"}))


@query(
    "histogram_sample",
    f""", sample AS (
      SELECT f0 FROM panel
      WHERE '0' || substr(md5('42:' || time_step || ':' || node_id), 1, 8) < '01999999a'),
    scaled AS (
      SELECT f0, (f0 - (SELECT avg(f0) FROM sample)) / (SELECT stddev_samp(f0) FROM sample) AS z
      FROM sample)
    SELECT 'raw' AS series, * FROM ({_hist_sql("f0", "scaled")})
    UNION ALL SELECT 'scaled', * FROM ({_hist_sql("round(z, 9)", "scaled")})""",
)
def histogram_sample(spark, sf):
    """The same on a repeatable tenth of the rows."""
    view = P.feature_view(fx.panel(spark, sf), {"f0": "x"})
    key = F.concat_ws(":", "time_step", "node_id")
    return _histograms(materialize(sampling.hash_sample(view, key, 0.1, seed=42), "sample"))


def _histograms(view):
    scaled = fit(view, ["x"], "std", "feature", ddof=1).transform(view)
    scaled = scaled.withColumn("x_scaled", F.round("x_scaled", 9))
    return rounded(stats.histograms(scaled, {"raw": "x", "scaled": "x_scaled"}), ["left_edge"])


@query(
    "lat_weights",
    f"""SELECT node_id, lat,
           {r("cos(radians(lat)) / avg(cos(radians(lat))) OVER ()")} AS lat_weight FROM stations""",
)
def lat_weights(spark, sf):
    return rounded(stats.lat_weights(fx.stations(spark, sf)), ["lat_weight"])


@query("time_range", "SELECT min(coord) AS first_coord, max(coord) AS last_coord FROM time_dim")
def time_range(spark, sf):
    return stats.time_range(fx.time_dim(spark, sf))


# --- top-1, samples, charts ---------------------------------------------------


@query(
    "hottest_cell",
    "SELECT time_step, node_id, f0 FROM panel ORDER BY f0 DESC, time_step, node_id LIMIT 1",
)
def hottest_cell(spark, sf):
    return sampling.hottest_cell(fx.panel(spark, sf), "f0")


@query("bernoulli_sample")
def bernoulli_sample(spark, sf):
    """Depends on the data layout, so there is no SQL twin; see hash_sample."""
    return sampling.bernoulli_sample(fx.panel(spark, sf), 0.01, seed=42).select(
        "time_step", "node_id", "f0"
    )


@query(
    "hash_sample",
    """SELECT time_step, node_id, f0 FROM panel
    WHERE '0' || substr(md5('42:' || time_step || ':' || node_id), 1, 8) < '0028f5c29'""",
)
def hash_sample(spark, sf):
    key = F.concat_ws(":", "time_step", "node_id")
    return sampling.hash_sample(
        fx.panel(spark, sf).select("time_step", "node_id", "f0"), key, 0.01, seed=42
    )


@query(
    "exact_sample",
    """SELECT time_step, node_id, f0 FROM panel
    QUALIFY row_number() OVER (ORDER BY md5('42:' || time_step || ':' || node_id)) <= count(*) OVER () // 100""",
)
def exact_sample(spark, sf):
    """One row in a hundred, exactly."""
    key = F.concat_ws(":", "time_step", "node_id")
    rows = fx.panel(spark, sf).select("time_step", "node_id", "f0")
    return sampling.exact_sample(rows, key, F.floor(F.count(F.lit(1)) / 100), seed=42)


@query(
    "stride_sample",
    f""", steps AS (SELECT time_step, avg(f1) AS a, max(f1) AS m FROM panel GROUP BY time_step)
    SELECT time_step, {r("a")} AS avg_value, m AS max_value
    FROM (SELECT *, row_number() OVER (ORDER BY time_step) - 1 AS i FROM steps)
    WHERE i % greatest((SELECT count(*) FROM steps) // 500, 1) = 0""",
)
def stride_sample(spark, sf):
    return rounded(report.step_series(fx.panel(spark, sf), "f1"), ["avg_value"])


@query(
    "grid_shape",
    """, w AS (SELECT count(*) AS n,
                   count(*) FILTER (lat = (SELECT arg_min(lat, node_id) FROM stations)) AS w
              FROM stations),
    h AS (SELECT max(d) AS h FROM (SELECT n, unnest(range(1, n + 1)) AS d FROM w)
          WHERE d * d <= n AND n % d = 0)
    SELECT CAST(CASE WHEN n % w = 0 THEN n // w ELSE h END AS INTEGER) AS height,
           CAST(CASE WHEN n % w = 0 THEN w ELSE n // h END AS INTEGER) AS width
    FROM w, h""",
)
def grid_shape(spark, sf):
    return report.grid_shape(fx.stations(spark, sf))


@query(
    "grid_cells",
    """SELECT time_step, CAST(node_id // 5 AS INTEGER) AS grid_row,
           CAST(node_id % 5 AS INTEGER) AS grid_col, f0 AS value FROM panel""",
)
def grid_cells(spark, sf):
    shape = report.grid_shape(fx.node_dim(spark, sf))
    return report.grid_cells(fx.panel(spark, sf), shape, "f0")


@query(
    "grid_heatmap",
    "SELECT time_step, CAST(node_id // 5 AS INTEGER) AS grid_row, "
    + ", ".join(f"max(CASE WHEN node_id % 5 = {i} THEN f0 END) AS c{i}" for i in range(5))
    + " FROM panel GROUP BY 1, 2",
)
def grid_heatmap(spark, sf):
    """The grid of every step; a chart shows one of them."""
    return report.grid_heatmap(fx.panel(spark, sf), fx.node_dim(spark, sf), "f0")
