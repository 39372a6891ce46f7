import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stpanel.operators.ordering import running, with_position
from stpanel.operators.sampling import hash_sample, hottest_cell, stride_sample
from stpanel.operators.storage import attach, cached, materialize, release, scratch_root
from stpanel.operators.shuffling import shuffle_positions
from stpanel.operators.windows import assign_batches, batches_per_epoch

NAN = float("nan")


@pytest.mark.parametrize("size", [3, 10, 1000])
def test_positions_follow_the_order(spark, size):
    rng = random.Random(1)
    rows = [(k, o) for k in "ab" for o in rng.sample(range(-50, 200), 60)]
    df = spark.createDataFrame(rows, "k string, o int")
    out = with_position(df, "o", ["k"], size=size).toPandas()
    want = pd.DataFrame(rows, columns=["k", "o"])
    want["pos"] = want.groupby("k")["o"].rank().astype(int) - 1
    pd.testing.assert_frame_equal(
        out.sort_values(["k", "o"]).reset_index(drop=True)[["k", "o", "pos"]],
        want.sort_values(["k", "o"]).reset_index(drop=True),
        check_dtype=False,
    )


@pytest.mark.parametrize("size", [2, 7, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_minimum(spark, size, inclusive):
    rng = random.Random(2)
    rows = [(k, o, None if rng.random() < 0.3 else rng.randint(0, 50)) for k in "ab" for o in range(40)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    out = running(
        df, "o", {"low": ("min", F.col("v")), "high": ("max", F.col("v"))}, ["k"], inclusive, size
    )
    for row in out.collect():
        seen = [
            v
            for k, o, v in rows
            if k == row["k"] and v is not None and (o <= row["o"] if inclusive else o < row["o"])
        ]
        assert row["low"] == (min(seen) if seen else None)
        assert row["high"] == (max(seen) if seen else None)


@pytest.mark.parametrize("n, points", [(4, 500), (1000, 500), (1499, 500), (23, 5)])
def test_stride_sample(spark, n, points):
    df = spark.range(n).select(F.col("id").cast("int").alias("time_step"))
    got = sorted(row[0] for row in stride_sample(df, points).collect())
    assert got == list(range(n))[:: max(1, n // points)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 500, 4097])
def test_shuffle_is_a_permutation_for_any_layout(spark, n):
    df = spark.range(n).select(F.lit("train").alias("split"), F.col("id").alias("sample_id"))

    def positions(rows, seed):
        out = shuffle_positions(rows, {"train": n, "empty": 0}, seed)
        return {r["sample_id"]: r["shuffled"] for r in out.collect()}

    one, two, other = positions(df, 3), positions(df.repartition(7), 3), positions(df, 4)
    assert one == two
    assert sorted(one.values()) == sorted(other.values()) == list(range(n))
    if n > 100:
        assert one != other
        moved = sum(abs(i - p) for i, p in one.items()) / n / n
        assert 0.25 < moved < 0.42  # a third on average for a random permutation


def test_shuffle_needs_no_exchange(spark):
    df = spark.range(100).select(F.lit("train").alias("split"), F.col("id").alias("sample_id"))
    plan = shuffle_positions(df, {"train": 100}, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_shuffle_of_foreign_ids(spark):
    rows = [("train", 0), ("train", 2), ("train", -1), ("train", None), ("other", 0), (None, 0)]
    df = spark.createDataFrame(rows, "split string, sample_id long")
    got = [r["shuffled"] for r in shuffle_positions(df, {"train": 2}, 1).collect()]
    assert got[0] in (0, 1) and got[1:] == [None] * 5
    assert shuffle_positions(df, {}, 1).where("shuffled IS NOT NULL").isEmpty()


@pytest.mark.parametrize("drop_last, sizes", [(False, [4, 4, 2]), (True, [4, 4])])
def test_batch_sizes(spark, drop_last, sizes):
    df = spark.range(10).select(F.lit("val").alias("split"), F.col("id").alias("sample_id"))
    batches = assign_batches(df, 4, drop_last)
    got = batches.groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [row["count"] for row in got] == sizes
    assert batches_per_epoch(batches).first()["n_batches"] == len(sizes)


def test_hash_sample_share(spark):
    df = spark.range(20_000)
    got = {r[0] for r in hash_sample(df, "id", 0.1).collect()}
    assert 1700 < len(got) < 2300
    assert got == {r[0] for r in hash_sample(df.repartition(5), "id", 0.1).collect()}
    assert hash_sample(df, "id", 1.0).count() == 20_000
    assert hash_sample(df, "id", 0.0).count() == 0


def test_hottest_cell_skips_nan_and_breaks_ties(spark):
    rows = [(0, 0, NAN), (1, 1, 9.0), (1, 0, 9.0), (2, 0, None), (3, 0, 1.0)]
    df = spark.createDataFrame(rows, "time_step int, node_id int, v double")
    assert tuple(hottest_cell(df, "v").first()) == (1, 0, 9.0)


def test_attach_broadcasts_only_below_the_limit(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    lookup = materialize(spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    hinted = attach(big, lookup, "k")
    plain = attach(big, lookup, "k", max_bytes=10)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(hinted).lower()
    assert "broadcast" not in plan(plain).lower()
    assert hinted.count() == plain.count() == 10
    vectors = materialize(lookup.withColumn("v", F.array_repeat(F.col("v"), 64)))
    assert "broadcast" not in plan(attach(big, vectors, "k")).lower()


def test_release_deletes_scratch_tables(spark):
    import os

    path = materialize(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    release(spark)
    assert not os.path.exists(path)


def test_scratch_is_the_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cached_ends_with_the_block(spark):
    with cached(spark.range(100)) as df:
        assert df.count() == 100
        assert df.storageLevel.useMemory and df.storageLevel.useDisk
    assert not df.storageLevel.useMemory
