import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stpanel.operators import splits as S
from stpanel.operators import windows as W
from tests.test_panel import cube


def steps_of(df):
    rows = df.select("split", "time_step").collect()
    return {
        split: sorted(r["time_step"] for r in rows if r["split"] == split) for split in S.SPLITS
    }


def dense(spark, n):
    return spark.range(n).select(F.col("id").cast("int").alias("time_step"))


@pytest.mark.parametrize("val, test", [(3, 4), (0, 4), (3, 0), (0, 0), (20, 5), (2.9, 3.9)])
def test_split_numbers(spark, val, test):
    got = steps_of(S.split_numbers(dense(spark, 20), val, test))
    n_test, n_tail = min(20, int(test)), min(20, int(val + test))
    want = list(range(20))
    assert got["train"] == want[: 20 - n_tail]
    assert got["val"] == want[20 - n_tail : 20 - n_test]
    assert got["test"] == want[20 - n_test :]


@pytest.mark.parametrize("val, test", [(0.1, 0.2), (0.15, 0.33), (0.0, 0.5)])
def test_split_ratio_truncates(spark, val, test):
    got = steps_of(S.split_ratio(dense(spark, 37), val, test))
    n_test, n_tail = int(37 * test), int(37 * (test + val))
    assert [len(got[s]) for s in S.SPLITS] == [37 - n_tail, n_tail - n_test, n_test]


def test_split_days(spark):
    got = steps_of(S.split_days(dense(spark, 20), 2, 1, interval=360))  # 4 steps a day
    assert [len(got[s]) for s in S.SPLITS] == [8, 8, 4]


def test_splits_count_rows_not_step_numbers(spark):
    some = dense(spark, 40).where("time_step % 3 = 0")  # 14 steps
    got = steps_of(S.split_numbers(some, 2, 3))
    assert got["test"] == [33, 36, 39] and got["val"] == [27, 30]


def test_calendar_bounds_are_half_open(spark):
    coords = pd.to_datetime(
        ["2005-12-31 18:00", "2006-01-01", "2015-12-31 18:00", "2016-01-01", "2017-01-01",
         "2019-01-01"],
        format="mixed",
    )
    rows = [(i, c.to_pydatetime()) for i, c in enumerate(coords)]
    dim = spark.createDataFrame(rows, "time_step int, coord timestamp_ntz")
    assert steps_of(S.split_calendar(dim)) == {"train": [1, 2], "val": [3], "test": [4]}
    S.require_splits(S.split_calendar(dim))
    with pytest.raises(ValueError):
        S.require_splits(S.split_calendar(dim.where("time_step IN (0, 3)")))


def test_split_sizes(spark):
    dim = spark.createDataFrame(
        [(i, "train" if i < 12 else "test") for i in range(15)], "time_step int, split string"
    )
    got = {r["split"]: (r["n_steps"], r["n_windows"]) for r in S.split_sizes(dim, 7, 4).collect()}
    assert got == {"train": (12, 2), "val": (0, 0), "test": (3, 0)}


@pytest.mark.parametrize("hour, want", [(0, 0.0), (5, 0.0), (6, 1 / 3), (12, 2 / 3), (18, 1.0), (23, 1.0)])
def test_time_of_day(spark, hour, want):
    dim = spark.sql(f"SELECT TIMESTAMP_NTZ '2006-05-01 {hour:02d}:30:00' AS coord")
    assert S.tod_feature(dim).first()["tod"] == pytest.approx(want)


def label(spark, sizes):
    rows, at = [], 0
    for split, n in sizes.items():
        rows += [(at + i, split) for i in range(n)]
        at += n
    return spark.createDataFrame(rows, "time_step int, split string")


def brute_windows(array, sizes, lag, horizon, single):
    """{(split, sample, node): (x, y)} by slicing each split alone."""
    out, at = {}, 0
    for split, n in sizes.items():
        part = array[at : at + n]
        at += n
        for i in range(n - lag - horizon + 1):
            y = part[i + lag : i + lag + horizon]
            for node in range(array.shape[1]):
                out[split, i, node] = (
                    part[i : i + lag, node].tolist(),
                    (y[-1:] if single else y)[:, node].tolist(),
                )
    return out


@pytest.mark.parametrize("sizes", [{"train": 30, "val": 9, "test": 12}, {"train": 11, "test": 10}])
@pytest.mark.parametrize("lag, horizon, single, size", [
    (7, 4, False, 4096), (7, 4, True, 11), (3, 1, False, 5), (1, 1, False, 2), (2, 5, True, 7),
])
def test_windows_equal_slicing(spark, sizes, lag, horizon, single, size):
    total = sum(sizes.values())
    array = np.random.default_rng(5).normal(size=(total, 3, 2))
    panel = W.split_panel(cube(spark, array), label(spark, sizes))
    got = W.sliding_windows(
        panel, lag, horizon, ["f0", "f1"], ["f0", "f1"], single=single, size=size
    ).collect()
    want = brute_windows(array, sizes, lag, horizon, single)
    assert len(got) == len(want)
    for r in got:
        x, y = want[r["split"], r["sample_id"], r["node_id"]]
        assert [list(s) for s in r["x"]] == x
        assert [list(s) for s in r["y"]] == y


def test_plan_does_not_grow_with_the_lag(spark):
    """A week of hourly inputs of eleven features, planned like seven steps of one."""
    columns = [f"f{i}" for i in range(11)]
    panel = cube(spark, np.random.default_rng(8).normal(size=(400, 2, 11)))
    plans = []
    for lag in (7, 168):
        df = W.sliding_windows(panel, lag, 24, columns, columns[:1], keys=["node_id"], pos="time_step")
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert abs(len(plans[1]) - len(plans[0])) < 100
    assert "Window" not in plans[1]
    assert df.count() == 2 * (400 - 168 - 24 + 1)
    row = df.where("node_id = 1 AND sample_id = 3").first()
    values = {r["time_step"]: r for r in panel.where("node_id = 1").collect()}
    assert [s["f10"] for s in row["x"]] == [values[t]["f10"] for t in range(3, 171)]
    assert [s["f0"] for s in row["y"]] == [values[t]["f0"] for t in range(171, 195)]


def test_missing_step_removes_the_windows_over_it(spark):
    array = np.arange(30.0).reshape(15, 2, 1)
    panel = cube(spark, array).where("NOT (node_id = 1 AND time_step = 6)")
    got = W.sliding_windows(
        panel, 2, 2, ["f0"], ["f0"], keys=["node_id"], pos="time_step", size=5
    )
    ids = {n: sorted(r["sample_id"] for r in got.where(F.col("node_id") == n).collect()) for n in (0, 1)}
    assert ids[0] == list(range(12))
    assert ids[1] == [i for i in range(12) if not i <= 6 <= i + 3]


def test_gappy_split_is_ranked(spark):
    """Positions count the steps of a split, also if it is not one run of steps."""
    dim = spark.createDataFrame(
        [(i, "val" if i in (4, 5) else "train") for i in range(10)], "time_step int, split string"
    )
    panel = cube(spark, np.arange(20.0).reshape(10, 2, 1))
    got = {
        (r["time_step"], r["split"]): r["pos"] for r in W.split_panel(panel, dim).collect()
    }
    assert [got[i, "train"] for i in (0, 3, 6, 9)] == [0, 3, 4, 7]
    assert [got[i, "val"] for i in (4, 5)] == [0, 1]
    train = S.split_rows(panel, dim, "train").select("time_step").distinct().count()
    assert train == 8
    assert S.split_rows(panel, dim, "test").isEmpty()


def test_sample_ids_and_long_forms(spark):
    sizes = {"train": 14, "test": 11}
    dim = label(spark, sizes)
    array = np.random.default_rng(6).normal(size=(25, 2, 3))
    panel = W.split_panel(cube(spark, array), dim)
    windows = W.exog_target_windows(panel, 7, 4, ["f0", "f1", "f2"])
    ids = {tuple(r) for r in windows.select("split", "sample_id").distinct().collect()}
    assert {tuple(r) for r in W.sample_ids(dim, 7, 4).collect()} == ids
    inputs = W.long_inputs(windows)
    assert inputs.columns == ["split", "node_id", "sample_id", "lag_pos", "f1", "f2"]
    assert inputs.count() == 5 * 2 * 7
    targets = W.long_targets(windows)
    row = targets.where("split = 'train' AND node_id = 1 AND sample_id = 2 AND horizon = 3").first()
    assert row["f0"] == array[2 + 7 + 2, 1, 0]
    flat = W.lag_vector(windows, ["f1", "f2"]).where(
        "split = 'test' AND node_id = 0"
    ).first()["lag_vector"]
    assert flat == array[14:21, 0, 1:].reshape(-1).tolist()


def test_window_arguments(spark):
    panel = cube(spark, np.zeros((4, 1, 1)))
    with pytest.raises(ValueError):
        W.sliding_windows(panel, 0, 1, ["f0"], ["f0"])
