import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stpanel.operators.panel import in_tensor_order
from stpanel.operators.splits import split_rows
from stpanel.operators.storage import scratch_root
from stpanel.sources import blocks, npy, tables
from tests.test_panel import cube, tensor


@pytest.fixture(scope="module")
def array():
    return np.random.default_rng(10).normal(280, 9, (23, 6, 3)).astype("float32")


def test_read_panel(spark, array, tmp_path):
    path = str(tmp_path / "x.npy")
    np.save(path, array)
    df = npy.read_npy(spark, path, features="t2m,rh,tp", partitionBytes=5 * 6 * 3 * 4)
    assert df.dtypes == [("time_step", "bigint"), ("node_id", "int")] + [
        (c, "double") for c in ("t2m", "rh", "tp")
    ]
    assert df.rdd.getNumPartitions() == 5
    np.testing.assert_array_equal(tensor(df, array.shape, ["t2m", "rh", "tp"]), array)
    part = npy.read_npy(spark, path, startStep=4, endStep=9)
    assert sorted({r[0] for r in part.select("time_step").collect()}) == [4, 5, 6, 7, 8]


def test_steps_and_columns_are_chosen_at_the_array(spark, array, tmp_path):
    path = str(tmp_path / "x.npy")
    np.save(path, array)
    options = {"features": "t2m,rh,tp", "columns": "tp,t2m", "partitionBytes": 2 * 6 * 3 * 4}
    df = npy.read_npy(spark, path, **options)
    assert df.columns == ["time_step", "node_id", "t2m", "tp"] and df.rdd.getNumPartitions() == 12
    part = npy.read_npy(spark, path, startStep=3, endStep=7, **options)
    assert part.rdd.getNumPartitions() == 2
    got = {(r["time_step"], r["node_id"]): (r["t2m"], r["tp"]) for r in part.collect()}
    assert got == {(t, n): (array[t, n, 0], array[t, n, 2]) for t in range(3, 7) for n in range(6)}
    assert npy.read_npy(spark, path, startStep=40, **options).collect() == []
    assert df.where("time_step = 40").collect() == []
    assert df.where("time_step = 5 OR node_id = 1").count() == 6 + 22


def test_read_matrix_vectors_and_edges(spark, tmp_path):
    matrix = np.arange(12.0).reshape(4, 3)
    np.save(tmp_path / "m.npy", matrix)
    df = npy.read_npy(spark, str(tmp_path / "m.npy"))
    np.testing.assert_array_equal(tensor(df, matrix.shape, ["f0"]), matrix)

    times = np.array(["2006-01-01T00", "2006-01-01T06"], dtype="datetime64[ns]")
    np.save(tmp_path / "t.npy", times)
    rows = npy.read_npy(spark, str(tmp_path / "t.npy"))
    dim = tables.load_time_dim(rows, "position", "value").orderBy("time_step").collect()
    assert [(r["time_step"], r["coord"].hour) for r in dim] == [(0, 0), (1, 6)]

    np.save(tmp_path / "lat.npy", np.array([-10.5, -20.0]))
    rows = npy.read_npy(spark, str(tmp_path / "lat.npy"))
    nodes = tables.load_node_dim(rows, "position", "value").orderBy("node_id").collect()
    assert [tuple(r) for r in nodes] == [(0, -10.5), (1, -20.0)]

    np.save(tmp_path / "e.npy", np.array([[0, 1, 1], [1, 0, 0]]))
    edges = npy.read_npy(spark, str(tmp_path / "e.npy"), layout="edges")
    assert sorted(tuple(r) for r in edges.collect()) == [(0, 1), (1, 0), (1, 0)]


def test_wide_steps_and_other_orders(spark, tmp_path):
    """Batches end inside a step; column-major files are refused."""
    wide = np.arange(2 * 70_000, dtype="int32").reshape(2, 70_000)
    np.save(tmp_path / "w.npy", wide)
    df = npy.read_npy(spark, "file://" + str(tmp_path / "w.npy"))
    row = df.agg(F.count("f0"), F.sum(F.abs(F.col("f0") - F.col("time_step") * 70_000 - F.col("node_id"))))
    assert tuple(row.first()) == (140_000, 0.0)
    np.save(tmp_path / "f.npy", np.asfortranarray(np.ones((3, 2))))
    with pytest.raises(PySparkException):
        npy.read_npy(spark, str(tmp_path / "f.npy")).count()


def test_bad_arrays_are_refused(spark, array, tmp_path):
    path = str(tmp_path / "x.npy")
    np.save(path, array)
    for options in ({"features": "a,b"}, {"layout": "edges"}, {"layout": "vector"}):
        with pytest.raises(PySparkException):
            npy.read_npy(spark, path, **options).count()


def test_write_is_the_array_file(spark, array, tmp_path):
    path = str(tmp_path / "out" / "x.npy")
    panel = cube(spark, array.astype("float64"), partitions=7)
    ordered = in_tensor_order(panel, *array.shape[:2], rows=20)
    assert ordered.rdd.getNumPartitions() == 7  # 138 cells
    npy.register(spark)
    ordered.write.format("npy").mode("append").options(steps=23, nodes=6).save(path)
    got = np.load(path)
    assert got.dtype == np.float32
    np.testing.assert_array_equal(got, array)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["x.npy"]


def test_runs_read_like_an_array(spark, array, tmp_path):
    path = str(tmp_path / "runs")
    panel = cube(spark, array.astype("float64"), partitions=7)
    for _ in range(2):  # written again, the old runs are no longer listed
        ordered = in_tensor_order(panel, *array.shape[:2], rows=20)
        npy.register(spark)
        ordered.write.format("npy").mode("overwrite").options(
            steps=23, nodes=6, dtype="float32", runs="true"
        ).save(path)
    df = npy.read_npy(spark, path, partitionBytes=3 * 6 * 3 * 4)
    np.testing.assert_array_equal(tensor(df, array.shape, ["f0", "f1", "f2"]), array)
    with pytest.raises(PySparkException):
        npy.write_npy(panel.where("time_step <> 4"), str(tmp_path / "gap"), 23, 6, runs=True)


@pytest.mark.parametrize("broken", ["missing", "repeated", "swapped", "outside"])
def test_write_refuses_a_panel_that_is_not_dense(spark, array, tmp_path, broken):
    panel = cube(spark, array.astype("float64"))
    one = panel.where("time_step = 5 AND node_id = 2")
    rest = panel.join(one.select("time_step", "node_id"), ["time_step", "node_id"], "left_anti")
    bad = {
        "missing": rest,
        "repeated": panel.unionByName(one),
        "swapped": rest.unionByName(panel.where("time_step = 5 AND node_id = 3")),
        "outside": rest.unionByName(one.withColumn("node_id", F.lit(6))),
    }[broken]
    with pytest.raises(PySparkException):
        npy.write_npy(bad, str(tmp_path / "x.npy"), *array.shape[:2])
    assert list(tmp_path.iterdir()) == []


def test_resolve_prefers_the_first_file(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        tables.resolve_source(spark, "other", root)
    with pytest.raises(FileNotFoundError):
        tables.resolve_source(spark, "GIS", root)
    np.save(tmp_path / "X_GIS.npy", np.ones((2, 2, 1)))
    assert tables.resolve_source(spark, "GIS", root).agg(F.sum("f0")).first()[0] == 4.0
    np.save(tmp_path / "X_GIS_spark.npy", np.zeros((2, 2, 1)))
    assert tables.resolve_source(spark, "GIS", root).agg(F.sum("f0")).first()[0] == 0.0
    spark.range(3).write.parquet(f"{root}/X_LA.parquet")
    assert tables.resolve_source(spark, "LA", root).count() == 3


def test_panel_and_tensor_files(spark, array, tmp_path):
    panel = cube(spark, array.astype("float64"))
    tables.write_panel(panel, str(tmp_path / "p"), bucket=10)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {r[0] for r in back.select("time_bucket").distinct().collect()} == {0, 1, 2}
    cols = ["f0", "f1", "f2"]
    np.testing.assert_array_equal(tensor(back, array.shape, cols), array)

    tables.export_tensor(panel, cols, str(tmp_path / "t"), *array.shape[:2])
    tensor_back = tables.read_tensor(spark, str(tmp_path / "t"), cols)
    assert dict(tensor_back.dtypes)["f0"] == "float"
    diff = tables.max_abs_difference(panel, tensor_back, cols).first()
    assert tuple(diff) == (0.0, 0.0, 0.0, 0)


def test_difference_ignores_nan_and_counts_lost_cells(spark):
    schema = "time_step int, node_id int, v double"
    nan = float("nan")
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, nan), (1, 0, 5.0)], schema)
    b = spark.createDataFrame([(0, 0, 1.5), (0, 1, 2.0), (1, 1, 5.0)], schema)
    row = tables.max_abs_difference(a, b, ["v"]).first()
    assert (row["diff_v"], row["unmatched"]) == (0.5, 2)


def test_journal_appends(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 2.0)], "run_id string, epoch int, rmse_w double")
    for _ in range(2):
        tables.append_journal(rows, str(tmp_path / "j"))
    got = spark.read.parquet(str(tmp_path / "j"))
    assert got.count() == 2 and got.where("logged_at IS NULL").isEmpty()


def test_step_filters_reach_the_files(spark, array, tmp_path):
    tables.write_panel(cube(spark, array.astype("float64")), str(tmp_path / "p"), bucket=5)
    stored = spark.read.parquet(str(tmp_path / "p"))
    steps = spark.createDataFrame(
        [(i, "train" if i < 15 else "test") for i in range(23)], "time_step int, split string"
    )
    train = split_rows(stored, steps, "train").where("time_bucket < 2").select("time_step", "f1")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time_step,0), LessThanOrEqual(time_step,14)" in plan
    assert "PartitionFilters: [isnotnull(time_bucket" in plan
    assert plan.split("ReadSchema: ")[1].split(">")[0] == "struct<time_step:int,f1:double"
    assert train.count() == 10 * 6


@pytest.fixture
def remote(spark, tmp_path):
    """A default file system that is not the local one, over a folder of this test."""
    (tmp_path / "store").mkdir()
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.remote.link./data", f"file://{tmp_path}/store")
    conf.set("fs.defaultFS", "viewfs://remote/")
    yield tmp_path / "store"
    conf.set("fs.defaultFS", before)


def test_paths_without_scheme_follow_the_default_file_system(spark, array, remote):
    panel = cube(spark, array.astype("float64"))
    npy.write_npy(panel, "/data/x", 23, 6)
    assert (remote / "x" / blocks.HEAD).exists()
    back = npy.read_npy(spark, "/data/x", features="t2m,rh,tp", columns="t2m,tp", startStep="4", endStep="9")
    assert back.columns == ["time_step", "node_id", "t2m", "tp"]
    np.testing.assert_array_equal(tensor(back, (5, 6, 2), ["t2m", "tp"]), array[4:9][:, :, [0, 2]])
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_blocks_across_their_size(spark, tmp_path):
    """More cells than a block holds, read whole and from within a block."""
    steps, nodes = 70, 2000
    cells = spark.range(steps * nodes).selectExpr("id div 2000 AS time_step", "cast(id % 2000 AS int) AS node_id", "cast(id AS double) AS v")
    path = str(tmp_path / "a")
    blocks.write_blocks(cells.repartition(5), path, steps, nodes, "float64")
    rows = spark.read.parquet(f"{path}/blocks")
    assert rows.agg({"cells": "max"}).first()[0] <= blocks.BLOCK_CELLS
    got = blocks.read_blocks(spark, path, start=33, end=34).agg({"v": "sum", "time_step": "min", "node_id": "count"}).first()
    assert set(got) == {float(sum(range(66_000, 68_000))), 33, 2000}
    assert blocks.read_blocks(spark, path).where("v = time_step * 2000 + node_id").count() == steps * nodes
    assert blocks.read_blocks(spark, path, start=70).count() == 0
    plan = blocks.read_blocks(spark, path, start=60)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(first" in plan and "LessThan(first" in plan


def test_blocks_refuse_panels_with_holes(spark, array, tmp_path):
    panel, path = cube(spark, array.astype("float64")), str(tmp_path / "b")
    for flawed in (panel.where("time_step <> 5 OR node_id <> 2"), panel.where("time_step < 22"), panel.unionByName(panel.where("time_step = 3"))):
        with pytest.raises(Exception, match="cells"):
            blocks.write_blocks(flawed, path, 23, 6)
        assert not blocks.is_blocks(spark, path)
    blocks.write_blocks(panel, path, 23, 6)
    with pytest.raises(ValueError, match="no such features"):
        blocks.read_blocks(spark, path, columns=["none"])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class System:
        def getUri(self):
            return self

        def getScheme(self):
            return "file"

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host"})
        _jsc = type("J", (), {"hadoopConfiguration": staticmethod(lambda: None)})

        class _jvm:
            class org:
                class apache:
                    class hadoop:
                        class fs:
                            class FileSystem:
                                get = staticmethod(lambda conf: System())

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Cluster)
