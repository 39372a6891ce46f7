"""Panels, dimensions, forecasts and runs derived from the given tables.

``CTES`` holds the same derivations as DuckDB common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.operators.ordering import with_position
from stpanel.operators.panel import NODE, TIME, flat_keys, flatten
from stpanel.operators.splits import split_calendar, split_rows
from stpanel.operators.stats import climatology, lat_weights
from stpanel.operators.storage import materialize
from stpanel.operators.windows import sliding_windows
from stpanel.sources.tables import load_edges, load_node_dim, load_time_dim

N_NODES = 25
LAG, HORIZON = 7, 4
FEATURES = ["f0", "f1", "f2", "f3"]
BOUNDS = {
    "train": ("2024-01-02", "2024-01-21"),
    "val": ("2024-01-21", "2024-01-26"),
    "test": ("2024-01-26", "2024-01-30"),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


FLAT = ("event_id", N_NODES)


def panel(
    spark: SparkSession, sf: str, steps: tuple[int, int] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """25 nodes, dense: value, user, a counter with zeros, and the hour."""
    features = {
        "f0": "value",
        "f1": "user_id",
        "f2": F.get_json_object("props", "$.k"),
        "f3": F.hour("ts"),
    }
    return flatten(table(spark, sf, "events"), *FLAT, features, keep, steps)


def n_steps(rows: DataFrame) -> int:
    return rows.agg(F.max(TIME) + 1).first()[0]


def time_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Stored time coordinates: the first event of each step."""
    step, _ = flat_keys("event_id", N_NODES)
    first = table(spark, sf, "events").groupBy(step).agg(F.min("ts").alias("coord"))
    return materialize(load_time_dim(first, TIME, "coord"), "time")


def node_dim(spark: SparkSession, sf: str) -> DataFrame:
    """5 x 5 grid, row-major."""
    key = F.col("n_nationkey")
    rows = table(spark, sf, "nation").select(
        key.alias(NODE),
        (F.floor(key / 5) * 6.0 - 40.0).alias("lat"),
        (F.pmod(key, F.lit(5)) * 8.0 + 114.0).alias("lon"),
    )
    return load_node_dim(rows, NODE, "lat", "lon")


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Grid of 50 columns with one node per customer."""
    key = F.col("c_custkey")
    row = F.call_function("div", key, F.lit(50)).cast("double")
    lat = row * 160.0 / (row + 320.0) - 80.0  # rises with the row, for any number of rows
    return load_node_dim(table(spark, sf, "customer").withColumn("lat", lat), "c_custkey", "lat")


def split_dim(spark: SparkSession, sf: str) -> DataFrame:
    return split_calendar(time_dim(spark, sf), BOUNDS)


def predictions(spark: SparkSession, sf: str, target: str = "f0") -> DataFrame:
    """Persistence forecast: the last input step, for each horizon step."""
    samples = sliding_windows(
        panel(spark, sf), LAG, HORIZON, [target], [target], keys=[NODE], pos=TIME
    )
    last = F.col("x")[LAG - 1][target]
    return samples.select(
        "sample_id", NODE, last.alias("pred"), F.posexplode("y").alias("_h", "_y")
    ).select(
        "sample_id",
        (F.col("_h") + 1).alias("horizon"),
        NODE,
        "pred",
        F.col(f"_y.{target}").alias("true"),
    )


def train_climatology(spark: SparkSession, sf: str) -> DataFrame:
    rows = panel(spark, sf, keep=["event_id"])
    train = split_rows(rows, split_dim(spark, sf), "train", FLAT)
    return climatology(train, node_dim(spark, sf), "f0")


def weights(spark: SparkSession, sf: str) -> DataFrame:
    return lat_weights(node_dim(spark, sf))


def grid_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours in the 5 x 5 grid: each node lists up to four others."""
    key = F.col(NODE)
    row, col = F.floor(key / 5), F.pmod(key, F.lit(5))
    near = F.filter(
        F.array(
            F.when(row > 0, key - 5),
            F.when(row < 4, key + 5),
            F.when(col > 0, key - 1),
            F.when(col < 4, key + 1),
        ),
        lambda n: n.isNotNull(),
    )
    rows = node_dim(spark, sf).select(key.alias("src"), F.explode(near).alias("dst"))
    return load_edges(rows, "src", "dst")


def order_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Part-to-supplier edges, with repeats."""
    return load_edges(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


def node_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """A vector for every end of an edge: means over its lines, in both roles."""
    lines = table(spark, sf, "lineitem")
    parts = ["l_quantity", "l_discount", "l_tax"]
    ends = [lines.select(F.col(key).alias(NODE), *parts) for key in ("l_partkey", "l_suppkey")]
    means = ends[0].unionByName(ends[1]).groupBy(NODE).agg(*[F.avg(c).alias(c) for c in parts])
    vector = F.array(F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0)
    return means.select(NODE, vector.alias("a"), F.reverse(vector).alias("b"))


def _monthly_orders(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("run_id"),
        (F.year(day) * 12 + F.month(day)).alias("month"),
        F.sqrt("o_totalprice").alias("loss"),
    )


def _with_epoch(months: DataFrame) -> DataFrame:
    """Number the months of each run from 1."""
    return with_position(months, "month", ["run_id"], "epoch").withColumn(
        "epoch", (F.col("epoch") + 1).cast("int")
    )


def order_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as training batches: a run per priority, an epoch per month."""
    rows = _monthly_orders(spark, sf)
    months = materialize(rows.select("run_id", "month").distinct(), "months")
    return rows.join(_with_epoch(months), ["run_id", "month"])


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Stored epoch metrics with ties; one run diverges, one has NaN losses."""
    months = _monthly_orders(spark, sf).groupBy("run_id", "month").agg(
        F.avg("loss").alias("_t"), F.stddev_samp("loss").alias("_v")
    )
    stats = _with_epoch(materialize(months, "months"))
    diverged = (F.col("run_id").startswith("3")) & (F.col("epoch") == 4)
    broken = (F.col("run_id").startswith("2")) & (F.pmod("epoch", F.lit(4)) == 1)
    table = stats.select(
        "run_id",
        "epoch",
        F.when(diverged, F.lit(2e6)).otherwise(F.col("_t")).alias("train_loss"),
        F.when(broken, F.lit(float("nan"))).otherwise(F.col("_v")).alias("val_loss"),
        F.round("_v").alias("rmse_w"),
        F.round(1.0 / F.col("_t"), 5).alias("acc_w"),
    )
    return materialize(table, "runs")


CTES = """WITH RECURSIVE panel AS (
  SELECT CAST(event_id // 25 AS BIGINT) AS time_step,
         CAST(event_id % 25 AS INTEGER) AS node_id,
         value AS f0, CAST(user_id AS DOUBLE) AS f1,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS f2,
         CAST(hour(ts) AS DOUBLE) AS f3, ts
  FROM events),
time_dim AS (SELECT time_step, min(ts) AS coord FROM panel GROUP BY time_step),
node_dim AS (
  SELECT n_nationkey AS node_id,
         CAST(-40.0 + 6.0 * (n_nationkey // 5) AS DOUBLE) AS lat,
         CAST(114.0 + 8.0 * (n_nationkey % 5) AS DOUBLE) AS lon
  FROM nation),
stations AS (
  SELECT CAST(c_custkey AS INTEGER) AS node_id,
         CAST(c_custkey // 50 AS DOUBLE) * 160.0::DOUBLE
           / (CAST(c_custkey // 50 AS DOUBLE) + 320.0::DOUBLE) - 80.0::DOUBLE AS lat
  FROM customer),
split_dim AS (
  SELECT time_step, coord,
         CASE WHEN coord < TIMESTAMP '2024-01-21' THEN 'train'
              WHEN coord < TIMESTAMP '2024-01-26' THEN 'val' ELSE 'test' END AS split
  FROM time_dim
  WHERE coord >= TIMESTAMP '2024-01-02' AND coord < TIMESTAMP '2024-01-30'),
split_panel AS (
  SELECT p.*, s.split, s.pos
  FROM panel p JOIN (
    SELECT time_step, split,
           CAST(row_number() OVER (PARTITION BY split ORDER BY time_step) - 1 AS BIGINT) AS pos
    FROM split_dim) s USING (time_step)),
predictions AS (
  SELECT CAST(x.time_step - 6 AS BIGINT) AS sample_id, CAST(h.horizon AS INTEGER) AS horizon,
         x.node_id, x.f0 AS pred, y.f0 AS "true", x.f2 AS pred2, y.f2 AS true2
  FROM panel x, (SELECT unnest([1, 2, 3, 4]) AS horizon) h JOIN panel y ON true
  WHERE y.node_id = x.node_id AND y.time_step = x.time_step + h.horizon
    AND x.time_step >= 6 AND x.time_step + 4 <= (SELECT max(time_step) FROM panel)),
weights AS (
  SELECT node_id, cos(radians(lat)) / avg(cos(radians(lat))) OVER () AS lat_weight
  FROM node_dim),
clim AS (
  SELECT n.node_id, coalesce(avg(p.f0), 0.0) AS clim
  FROM node_dim n LEFT JOIN (SELECT * FROM split_panel WHERE split = 'train') p USING (node_id)
  GROUP BY n.node_id),
grid_edges AS (
  SELECT CAST(a.node_id AS BIGINT) AS src, CAST(b.node_id AS BIGINT) AS dst
  FROM node_dim a, node_dim b
  WHERE abs(a.node_id // 5 - b.node_id // 5) + abs(a.node_id % 5 - b.node_id % 5) = 1),
order_edges AS (
  SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem),
vectors AS (
  SELECT node_id, [avg(q) / 50.0, avg(d) * 10.0, avg(t) * 10.0] AS a,
         [avg(t) * 10.0, avg(d) * 10.0, avg(q) / 50.0] AS b
  FROM (SELECT l_partkey AS node_id, l_quantity AS q, l_discount AS d, l_tax AS t FROM lineitem
        UNION ALL SELECT l_suppkey, l_quantity, l_discount, l_tax FROM lineitem)
  GROUP BY node_id),
adjacency AS (
  SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM order_edges GROUP BY src, dst),
batches AS (
  SELECT o_orderpriority AS run_id, sqrt(o_totalprice) AS loss,
         CAST(dense_rank() OVER (PARTITION BY o_orderpriority
              ORDER BY year(o_orderdate) * 12 + month(o_orderdate)) AS INTEGER) AS epoch
  FROM orders),
runs AS (
  SELECT run_id, epoch,
         CASE WHEN run_id LIKE '3%' AND epoch = 4 THEN 2e6 ELSE avg(loss) END AS train_loss,
         CASE WHEN run_id LIKE '2%' AND epoch % 4 = 1 THEN CAST('NaN' AS DOUBLE)
              ELSE stddev_samp(loss) END AS val_loss,
         round(stddev_samp(loss)) AS rmse_w, round(1.0 / avg(loss), 5) AS acc_w
  FROM batches GROUP BY run_id, epoch)
"""
