import numpy as np
import pytest
from pyspark.sql import functions as F

from stpanel.operators import moments as M
from stpanel.operators.scaling import fit
from stpanel.sources.appends import append_once, committed, read_appends

FEATURES = ["f0", "f1"]


@pytest.fixture(scope="module")
def panel(spark):
    r = np.random.default_rng(4)
    rows = [(t, n, float(r.normal(1e6, 2)), float(r.integers(0, 5)) if r.random() < 0.9 else None) for t in range(60) for n in range(4)]
    return spark.createDataFrame(rows, "time_step int, node_id int, f0 double, f1 double")


def parts(panel, cuts, by=("node_id",)):
    edges = [0, *cuts, 10**6]
    made = None
    for a, b in zip(edges, edges[1:], strict=False):
        part = M.moments(panel.where((F.col("time_step") >= a) & (F.col("time_step") < b)), FEATURES, list(by))
        made = part if made is None else made.unionByName(part)
    return made


@pytest.mark.parametrize("cuts", [[30], [0, 1, 59, 70]])
@pytest.mark.parametrize("kind, scope, ddof", [("std", "feature", 1), ("std", "global", 0), ("std", "column", 0), ("max01", "feature", 0), ("max11", "global", 0), ("cmax", "column", 0)])
def test_merged_fit_is_the_fit_of_all(spark, panel, cuts, kind, scope, ddof):
    want = fit(panel, FEATURES, kind, scope, ddof)
    got = M.scaler(parts(panel, cuts), FEATURES, kind, scope, ddof)
    a = {r["time_step"] * 10 + r["node_id"]: r for r in want.transform(panel).collect()}
    b = {r["time_step"] * 10 + r["node_id"]: r for r in got.transform(panel).collect()}
    for key, row in a.items():
        for c in ("f0_scaled", "f1_scaled"):
            assert b[key][c] == (None if row[c] is None else pytest.approx(row[c], rel=1e-9, abs=1e-9))


def test_order_and_grouping_of_merges_do_not_matter(spark, panel):
    all_at_once = {tuple(r)[:2]: r for r in M.merge(parts(panel, [7, 20, 41]), ["node_id", "feature"]).collect()}
    some = M.merge(parts(panel, [7]), ["node_id", "feature"])
    again = {tuple(r)[:2]: r for r in M.merge(some.unionByName(M.moments(panel.limit(0), FEATURES, ["node_id"])), ["node_id", "feature"]).collect()}
    for key, row in all_at_once.items():
        assert again[key]["n"] == row["n"]
        assert again[key]["m2"] == pytest.approx(row["m2"], rel=1e-9)


def test_deviation_at_a_large_offset(spark):
    rows = [(i, 0, 1e8 + v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "time_step int, node_id int, f0 double")
    two = M.moments(df.where("time_step < 1"), ["f0"]).unionByName(M.moments(df.where("time_step >= 1"), ["f0"]))
    row = M.merge(two).first()
    assert row["m2"] == pytest.approx(5.0, abs=1e-6) and row["mean"] == 1e8 + 2.5


def test_nothing_to_merge(spark, panel):
    none = M.merge(M.moments(panel.limit(0), FEATURES, ["node_id"]), ["node_id", "feature"])
    assert none.count() == 0
    row = M.merge(M.moments(panel.select("time_step", "node_id", F.lit(None).cast("double").alias("f0")), ["f0"])).first()
    assert (row["n"], row["mean"], row["m2"], row["low"]) == (0, None, None, None)


def test_climatology_from_moments(spark, panel):
    nodes = spark.createDataFrame([(i,) for i in range(5)], "node_id int")
    got = {r["node_id"]: r["clim"] for r in M.climatology(parts(panel, [11]), nodes, "f0").collect()}
    want = {r[0]: r[1] for r in panel.groupBy("node_id").avg("f0").collect()}
    assert got.pop(4) == 0.0
    assert got == pytest.approx(want)


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    odd = "week 1/ü%:+."
    assert append_once(rows, path, odd) and not append_once(rows, path, odd)
    assert append_once(rows.withColumn("more", F.lit(2)), path, "2")
    got = sorted((r["batch"], r["k"], r["more"]) for r in read_appends(spark, path).collect())
    assert got == [("2", 1, 2), (odd, 1, None)]
    assert sorted(committed(spark, path)) == ["2", odd]
    with pytest.raises(ValueError):
        append_once(rows, path, "..")
    with pytest.raises(ValueError):
        read_appends(spark, str(tmp_path / "none"))


def test_a_dead_writer_leaves_no_rows_and_blocks_nobody(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1,)], "k int")
    rows.write.parquet(f"{path}/rows/b-{'0' * 32}")  # written, never marked
    (tmp_path / "log" / "_batches").mkdir()
    (tmp_path / "log" / "_batches" / "b").touch()  # marked without content
    assert committed(spark, path) == {}
    assert append_once(rows, path, "b")
    assert read_appends(spark, path).count() == 1
