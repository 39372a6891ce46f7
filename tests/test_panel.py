import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stpanel.operators import panel as P
from stpanel.operators import report, stats
from stpanel.operators.scaling import fit, one_hot, one_hot_long
from stpanel.operators.splits import split_sizes

NAN = float("nan")


def cube(spark, array, partitions=3):
    """Panel of an array (T, N, F)."""
    t, n, f = array.shape
    frame = pd.DataFrame(array.reshape(t * n, f), columns=[f"f{i}" for i in range(f)])
    frame.insert(0, "node_id", np.tile(np.arange(n, dtype="int32"), t))
    frame.insert(0, "time_step", np.repeat(np.arange(t, dtype="int32"), n))
    return P.ingest_frame(spark, frame).repartition(partitions)


def tensor(df, shape, cols):
    frame = df.orderBy("time_step", "node_id").select(*cols).toPandas()
    return frame.to_numpy().reshape(shape)


@pytest.fixture(scope="module")
def array():
    return np.random.default_rng(0).normal(280, 10, (12, 5, 3))


@pytest.fixture(scope="module")
def panel(spark, array):
    return cube(spark, array)


def dims(spark, t, n):
    steps = spark.range(t).select(F.col("id").cast("int").alias("time_step"))
    nodes = spark.range(n).select(F.col("id").cast("int").alias("node_id"))
    return steps, nodes


def test_flatten_is_row_major(spark):
    rows = spark.range(12).withColumn("x", F.col("id") * 1.0)
    got = P.flatten(rows, "id", 4, {"x": "x"}).orderBy("time_step", "node_id").collect()
    assert [tuple(r) for r in got] == [(i // 4, i % 4, float(i)) for i in range(12)]


def test_matrix_to_panel(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "t int, v array<float>")
    got = sorted(tuple(r) for r in P.matrix_to_panel(df, "t", "v").collect())
    assert got == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]


def test_ingest_keeps_types(spark):
    frame = pd.DataFrame(
        {"k": np.arange(2, dtype="int32"), "x": np.array([1.5, NAN], dtype="float32")}
    )
    got = P.ingest_frame(spark, frame)
    assert got.dtypes == [("k", "int"), ("x", "float")]
    assert [tuple(r) for r in got.orderBy("k").collect()] == [(0, 1.5), (1, None)]


def test_keys_of_large_indices(spark):
    df = spark.createDataFrame([(10**13 + 7,), (2**53 + 3,), (60_000_000_000,)], "i long")
    got = sorted(tuple(r) for r in df.select(*P.flat_keys("i", 25)).collect())
    assert got == sorted((i // 25, i % 25) for i in (10**13 + 7, 2**53 + 3, 60_000_000_000))


@pytest.mark.parametrize("name", ["time_slice", "climatology", "train_fit"])
def test_step_bounds_reach_the_scan(spark, name):
    from stpanel.plans import fixtures as fx
    from stpanel.plans import panels  # noqa: F401
    from stpanel.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    if name == "time_slice":
        df = QUERIES[name](spark, sf)
    else:
        from stpanel.operators.splits import split_rows

        df = split_rows(fx.panel(spark, sf, keep=["event_id"]), fx.split_dim(spark, sf), "train", fx.FLAT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id" in plan and "LessThanOrEqual(event_id" in plan


def test_gaps_and_duplicates(spark, panel):
    steps, nodes = dims(spark, 12, 5)
    holes = {(0, 0), (11, 4), (5, 2), (6, 2)} | {(t, 3) for t in range(12)}
    hole_rows = spark.createDataFrame(list(holes), "time_step int, node_id int")
    some = panel.join(hole_rows, ["time_step", "node_id"], "left_anti")
    got = {tuple(r) for r in P.panel_gaps(some, steps, nodes).collect()}
    assert got == holes
    assert P.panel_gaps(panel, steps, nodes).isEmpty()
    assert P.panel_duplicates(panel).isEmpty()
    twice = panel.unionByName(panel.where("time_step = 3 AND node_id = 1"))
    assert [tuple(r) for r in P.panel_duplicates(twice).collect()] == [(3, 1, 2)]


def test_gaps_across_bitmap_ranges(spark):
    """Steps around a range's end, a range without rows, and rows the dimension does not have."""
    at = [0, 7, 8, 32_766, 32_767, 32_768, 32_769, 98_304]
    steps = spark.createDataFrame([(t,) for t in at], "time_step int")
    nodes = spark.createDataFrame([(0,), (40_000,)], "node_id int")
    there = [(t, 0) for t in at if t not in (7, 32_768)] + [(32_767, 40_000), (5, 0), (None, 0), (0, None)]
    panel = spark.createDataFrame(there, "time_step int, node_id int")
    got = {tuple(r) for r in P.panel_gaps(panel, steps, nodes).collect()}
    assert got == {(7, 0), (32_768, 0)} | {(t, 40_000) for t in at if t != 32_767}
    row = P.shape_check(panel, steps, nodes).first()
    assert (row["n_rows"], row["n_steps"], row["n_nodes"]) == (10, 7, 2)


def test_distinct_counts_build_no_sets(spark, panel):
    steps, nodes = dims(spark, 12, 5)
    split = steps.withColumn("split", F.lit("train"))
    for df in (P.panel_gaps(panel, steps, nodes), P.shape_check(panel, steps, nodes), split_sizes(split, 3, 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "collect_set" not in plan and "Expand" not in plan
    empty = P.shape_check(panel.limit(0), steps, nodes).first()
    assert (empty["n_rows"], empty["n_steps"], empty["n_nodes"]) == (0, 0, 0)


def test_shapes(spark, panel):
    steps, nodes = dims(spark, 12, 5)
    P.require_shapes(panel, steps, nodes)
    with pytest.raises(ValueError):
        P.require_shapes(panel, steps, nodes.where("node_id < 4"))
    with pytest.raises(ValueError):
        P.require_shapes(panel.where("time_step < 11"), steps, nodes)


def test_missing_audit_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, NAN), (None, 2.0), (NAN, 3.0)], "a double, b double")
    row = stats.missing_audit(df, ["a", "b"]).first()
    assert (row["missing_a"], row["missing_b"], row["missing_total"]) == (2, 1, 3)
    empty = stats.missing_audit(df.where("a > 100 AND b < 0"), ["a"]).first()
    assert empty["missing_total"] == 0


@pytest.mark.parametrize("values", [
    [3.0], [3.0, 1.0], [5.0] * 7, [1.0, 2.0, 2.0, 9.0],
    list(np.random.default_rng(1).normal(size=501)),
    list(np.random.default_rng(2).integers(0, 9, 400).astype(float)),
    [0.0] * 300 + list(np.random.default_rng(3).normal(size=200)) + [1e300],
])
@pytest.mark.parametrize("sketch, slack", [(8, 0.001), (8192, 0.003)])
def test_exact_median(spark, monkeypatch, values, sketch, slack):
    """Coarse sketches miss the rank, which must be noticed."""
    monkeypatch.setattr(stats, "SKETCH", sketch)
    monkeypatch.setattr(stats, "SLACK", slack)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert stats.exact_median(df, "v") == np.median(values)


def test_exact_median_over_columns(spark):
    r = np.random.default_rng(5)
    table = np.stack([r.normal(0, 1, 999), r.normal(50, 9, 999), r.integers(0, 3, 999)], axis=1)
    df = spark.createDataFrame([tuple(map(float, row)) for row in table], "a double, b double, c double")
    assert stats.exact_median(df, ["a", "b", "c"]) == np.median(table)
    assert stats.panel_profile(
        df.selectExpr("1L AS time_step", "2 AS node_id", "*"), ["a", "b", "c"]
    ).first()["median_value"] == np.median(table)


def test_median_of_nothing_and_nan(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert stats.exact_median(df, "v") is None
    with_nan = spark.createDataFrame([(1.0,), (NAN,)], "v double")
    assert math.isnan(stats.exact_median(with_nan, "v"))


def test_profile(panel, array):
    row = stats.panel_profile(panel, ["f0", "f1", "f2"]).first()
    assert (row["n_steps"], row["n_nodes"], row["n_features"]) == array.shape
    assert row["max_value"] == array.max() and row["min_value"] == array.min()
    assert row["mean_value"] == pytest.approx(array.mean())
    assert row["median_value"] == np.median(array)
    rough = stats.panel_profile(panel, ["f0", "f1", "f2"], exact=False).first()
    assert rough["median_value"] == pytest.approx(np.median(array), abs=0.5)


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(4).normal(size=1000)), [2.0] * 5, [0.0, 1.0], [0.0, 0.0, 60.0],
])
def test_histogram_equals_array_library(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(NAN,), (None,)], "v double")
    got = stats.histogram(df, "v", 60).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=60)
    assert [row["n"] for row in got] == counts.tolist()
    assert [row["left_edge"] for row in got] == pytest.approx(edges[:-1].tolist())


def test_climatology_of_nothing_is_zero(spark, panel, array):
    _, nodes = dims(spark, 12, 5)
    got = stats.climatology(panel, nodes, "f0").orderBy("node_id").toPandas()["clim"]
    np.testing.assert_allclose(got, array[:, :, 0].mean(axis=0))
    none = stats.climatology(panel.where("time_step < 0"), nodes, "f0").toPandas()["clim"]
    assert none.tolist() == [0.0] * 5


def test_lat_weights_average_to_one(spark):
    df = spark.createDataFrame([(i, -40.0 + 5 * i) for i in range(9)], "node_id int, lat double")
    got = stats.lat_weights(df).orderBy("node_id").toPandas()["lat_weight"]
    cosine = np.cos(np.radians(-40 + 5 * np.arange(9)))
    np.testing.assert_allclose(got, cosine / cosine.mean())


# --- normalizers --------------------------------------------------------------

AXES = {"global": None, "feature": (0, 1), "column": 0}


def expected(array, kind, scope):
    axis = AXES["column" if kind == "cmax" else scope]
    if kind == "none":
        return array
    if kind == "std":
        return (array - array.mean(axis=axis, keepdims=True)) / array.std(axis=axis, keepdims=True)
    lo, hi = array.min(axis=axis, keepdims=True), array.max(axis=axis, keepdims=True)
    unit = (array - lo) / (hi - lo)
    return unit * 2 - 1 if kind == "max11" else unit


@pytest.mark.parametrize("kind", ["none", "std", "max01", "max11", "cmax"])
@pytest.mark.parametrize("scope", ["global", "feature", "column"])
def test_scaler_and_inverse(panel, array, kind, scope):
    cols = ["f0", "f1", "f2"]
    scaler = fit(panel, cols, kind, scope)
    scaled = scaler.transform(panel, suffix="")
    assert scaled.columns == panel.columns
    np.testing.assert_allclose(
        tensor(scaled, array.shape, cols), expected(array, kind, scope), rtol=1e-9, atol=1e-9
    )
    back = scaler.inverse(scaled, {c: c for c in cols})
    np.testing.assert_allclose(tensor(back, array.shape, cols), array, rtol=1e-9)


def test_scaler_sample_deviation_and_names(panel, array):
    scaled = fit(panel, ["f0"], "std", "feature", ddof=1).transform(panel)
    want = (array[:, :, 0] - array[:, :, 0].mean()) / array[:, :, 0].std(ddof=1)
    np.testing.assert_allclose(tensor(scaled, (12, 5), ["f0_scaled"]), want, rtol=1e-9)
    pooled = fit(panel, ["f0", "f1"], "std", "global", ddof=1).transform(panel)
    both = array[:, :, :2]
    want = (both - both.mean()) / both.std(ddof=1)
    got = tensor(pooled, both.shape, ["f0_scaled", "f1_scaled"])
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_scaler_zero_range(spark):
    df = spark.createDataFrame([(0, 0, 2.0), (1, 0, 2.0)], "time_step int, node_id int, v double")
    for kind in ("std", "max01"):
        got = fit(df, ["v"], kind, "feature").transform(df).collect()
        assert all(math.isnan(row["v_scaled"]) for row in got)
    got = fit(df, ["v"], "cmax").transform(df).collect()
    assert [row["v_scaled"] for row in got] == [0.0, 0.0]


def test_scaler_fit_on_train_keeps_other_rows(panel, array):
    scaler = fit(panel.where("time_step < 6"), ["f0"], "std", "column")
    train = array[:6, :, 0]
    want = (array[:, :, 0] - train.mean(axis=0)) / train.std(axis=0)
    np.testing.assert_allclose(
        tensor(scaler.transform(panel), (12, 5), ["f0_scaled"]), want, rtol=1e-9
    )


def test_unknown_normalizer(panel):
    with pytest.raises(ValueError):
        fit(panel, ["f0"], "other")


def test_one_hot(spark):
    table = np.array([[0, 0, 0, 1], [0, 1, 3, 2], [0, 2, 1, 3]])
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *map(int, row)) for i, row in enumerate(table)],
                               "id int, a int, b int, c int, d int")
    rows = one_hot(df, cols).orderBy("id").collect()
    wide = np.array([[x for c in cols for x in r[c]] for r in rows])
    want = np.hstack([np.eye(int(np.ptp(v)) + 1, dtype=int)[v - v.min()] for v in table.T])
    np.testing.assert_array_equal(wide, want)
    ones = {(r["id"], r["position"]) for r in one_hot_long(df, ["id"], cols).collect()}
    assert ones == {(i, j) for i in range(3) for j in np.flatnonzero(want[i])}
    none = spark.createDataFrame([(1, None), (2, None)], "id int, a int")
    assert [r["a"] for r in one_hot(none, ["a"]).collect()] == [None, None]
    assert one_hot(none.limit(0), ["a"]).collect() == []
    wide = spark.createDataFrame([(0,), (5000,)], "a int")
    assert [len(r["a"]) for r in one_hot(wide, ["a"]).collect()] == [5001, 5001]


# --- grids --------------------------------------------------------------------


@pytest.mark.parametrize("lats, shape", [
    ([1, 1, 1, 2, 2, 2], (2, 3)),
    ([1, 1, 1, 1, 2, 2], (2, 3)),  # 4 does not divide 6
    (list(range(6)), (6, 1)),
])
def test_grid_shape(spark, lats, shape):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(lats)], "node_id int, lat double")
    assert tuple(report.grid_shape(df).first()) == shape


@pytest.mark.parametrize("n, shape", [(165, (11, 15)), (7, (1, 7)), (25, (5, 5)), (1, (1, 1))])
def test_grid_shape_without_latitudes(spark, n, shape):
    df = spark.range(n).select(F.col("id").cast("int").alias("node_id"))
    assert tuple(report.grid_shape(df, lat=None).first()) == shape


def test_heatmap(spark):
    nodes = spark.createDataFrame([(i, float(i // 3)) for i in range(6)], "node_id int, lat double")
    slice_ = spark.createDataFrame([(i, i * 10.0) for i in range(6)], "node_id int, v double")
    got = report.grid_heatmap(slice_, nodes, "v").orderBy("grid_row").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 10.0, 20.0), (1, 30.0, 40.0, 50.0)]
