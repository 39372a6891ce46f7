import math

import pytest
from pyspark.sql import functions as F

from stpanel.functions import scores as M
from stpanel.functions.scalar import dot, finite, ieee_div, is_missing
from stpanel.operators import scoring as S

NAN, INF = float("nan"), float("inf")


def one(df, col):
    return df.agg(col.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def small(spark):
    """Forecasts 1 2 3 4 for the truths 2 1 4 5, one node and horizon."""
    rows = [(i, 1, 0, p, t) for i, (p, t) in enumerate(zip([1.0, 2.0, 3.0, 4.0], [2.0, 1.0, 4.0, 5.0]))]
    return spark.createDataFrame(
        rows, "sample_id long, horizon int, node_id int, pred double, true double"
    )


@pytest.mark.parametrize(
    "score, expected",
    [
        ("mae", 1.0),
        ("mse", 1.0),
        ("rmse", 1.0),
        ("mape", 0.4875),
        ("rrse", 0.632456),
        ("mare", 1 / 3),
        ("smape", 0.230159),
        ("pnbi", 0.25),
        ("opnbi", 1.00625),
    ],
)
def test_worked_example(small, score, expected):
    assert one(small, getattr(M, score)()) == pytest.approx(expected, abs=1e-6)


def test_worked_example_variants(small):
    assert one(small, M.rrse(variant="forecast")) == pytest.approx(0.816497, abs=1e-6)
    assert S.correlation(small).first()["corr"] == pytest.approx(0.848528, abs=1e-6)
    assert S.correlation(small, ddof=1).first()["corr"] == pytest.approx(0.636396, abs=1e-6)
    with pytest.raises(ValueError):
        M.rrse(variant="other")


def test_bundle_equals_single_scores(small):
    row = S.metric_bundle(small, variant="forecast", ddof=1).first()
    assert row["rrse"] == pytest.approx(0.816497, abs=1e-6)
    assert row["corr"] == pytest.approx(0.636396, abs=1e-6)
    pair = S.metric_pair(small).first()
    assert (pair["rrse"], pair["corr"]) == (row["rrse"], row["corr"])
    masked = S.metric_bundle(small, mask=1.5, ratio_mask=4.0).first()
    assert masked["mae"] == 1.0
    assert masked["mape"] == pytest.approx(0.2)
    assert masked["rrse"] == pytest.approx(
        small.where("`true` > 1.5").agg(M.rrse().alias("v")).first()["v"]
    )


def test_mask_is_strict_and_empty_mask_scores_null(small):
    assert one(small, M.mae(mask=2.0)) == 1.0
    assert one(small, F.count(M.kept(F.col("pred"), F.col("true"), 2.0))) == 2
    assert one(small, M.mae(mask=5.0)) is None
    bundle = S.metric_bundle(small, mask=5.0, ratio_mask=5.0).first()
    assert bundle["mae"] is None and bundle["mape"] is None


def test_nan_truth_is_never_kept(spark):
    df = spark.createDataFrame([(1.0, NAN), (3.0, 5.0)], "pred double, true double")
    assert one(df, M.mae(mask=0.0)) == 2.0
    assert math.isnan(one(df, M.mae()))


def test_zero_truth(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 5.0)], "pred double, true double")
    assert one(df, M.mape()) == INF
    assert one(df, M.mape(mask=0.0)) == pytest.approx(0.4)
    zeros = df.where("`true` = 0")
    assert S.nonzero_scores(zeros).first()["mae"] is None
    assert S.nonzero_scores(df).first()["mae"] == 2.0


def test_constant_truth(spark):
    rows = [(i, 1, n, float(i), 3.0 if n == 0 else float(2 * i)) for i in range(4) for n in range(2)]
    df = spark.createDataFrame(
        rows, "sample_id long, horizon int, node_id int, pred double, true double"
    )
    assert S.correlation(df).first()["corr"] == pytest.approx(1.0)
    only = df.where("node_id = 0")
    assert S.correlation(only).first()["corr"] is None
    assert one(only, M.rrse()) == INF
    assert S.metric_bundle(only).first()["rrse"] == INF


def test_constant_forecast_gives_nan(spark):
    df = spark.createDataFrame(
        [(i, 1, 0, 2.0, float(i)) for i in range(4)],
        "sample_id long, horizon int, node_id int, pred double, true double",
    )
    assert math.isnan(S.correlation(df).first()["corr"])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ieee_div(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = [(1.0, 0.0, INF), (-1.0, 0.0, -INF), (0.0, 0.0, NAN), (6.0, 3.0, 2.0),
                 (NAN, 0.0, NAN), (None, 0.0, None), (1.0, None, None), (1.0, NAN, NAN)]
        df = spark.createDataFrame(cases, "a double, b double, want double")
        for row in df.select(ieee_div(F.col("a"), F.col("b")).alias("got"), "want").collect():
            same = row["got"] == row["want"] or (
                row["got"] is not None and math.isnan(row["got"]) and math.isnan(row["want"])
            )
            assert same, row
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_missing_and_finite(spark):
    df = spark.createDataFrame([(None,), (NAN,), (INF,), (1.0,)], "x double")
    got = df.select(is_missing("x").alias("m"), finite("x").alias("f")).collect()
    assert [row["m"] for row in got] == [True, True, False, False]
    assert [row["f"] for row in got] == [None, None, None, 1.0]


def test_dot(spark):
    df = spark.sql("SELECT array(1.5F, 2F) AS a, array(2F, -1F) AS b")
    assert df.select(dot("a", "b").alias("v")).first()["v"] == 1.0
