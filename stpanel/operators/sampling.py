"""Top-1, samples and physical layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.functions.scalar import as_col, is_missing
from stpanel.operators.ordering import with_position
from stpanel.operators.panel import NODE, TIME


def hottest_cell(panel: DataFrame, col: str) -> DataFrame:
    """Row with the highest value; ties go to the first step and node.

    Missing values are left out, as NaN would sort above every number.
    """
    return (
        panel.where(~is_missing(col))
        .orderBy(F.col(col).desc(), TIME, NODE)
        .select(TIME, NODE, col)
        .limit(1)
    )


def bernoulli_sample(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """Random sample; repeatable only for the same data layout."""
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame, key: str | Column, fraction: float = 0.01, seed: int = 42
) -> DataFrame:
    """Random sample by a hash of ``key``, the same for any layout or engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), as_col(key).cast("string")))
    below = f"{round(fraction * 16**8):09x}"
    return df.where(F.concat(F.lit("0"), F.substring(digest, 1, 8)) < below)


DIGITS = 4  # hex digits of the priority that one round of the search settles
FEW = 10_000  # rows that may be ranked by the driver


def exact_sample(df: DataFrame, key: str | Column, rows: Column | int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` random rows, the same for any layout or engine.

    ``rows`` is a number or an aggregate such as ``floor(count(1) / 100)``. A row's
    priority is a hash of seed and key; the rows of lowest priority are the sample,
    found by their largest priority: each round counts the rows below by the next
    four digits (65,536 groups at most) until few share the prefix. The sample is
    then a filter. Keys must be unique and not NULL; with fewer rows all are taken.
    """
    text = as_col(key).cast("string")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), text))
    rank = df.select(digest.alias("priority"), text.alias("key"))
    if isinstance(rows, Column):
        rows = df.agg(rows.cast("long")).first()[0]
    if rows <= 0:
        return df.where(F.lit(False))
    prefix, left = "", rows
    while True:
        level = len(prefix) + DIGITS
        inside = rank.where(F.startswith("priority", F.lit(prefix)))
        counts = inside.groupBy(F.substring("priority", 1, level).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        step = None
        for r in sorted(counts):
            if left <= r["n"]:
                step = r
                break
            left -= r["n"]
        if step is None:
            return df  # fewer rows than asked for
        prefix = step["p"]
        if step["n"] <= FEW or level >= 32:
            break
    last = inside.where(F.startswith("priority", F.lit(prefix))).orderBy("priority", "key").limit(left)
    end = last.agg(F.max(F.struct("priority", "key"))).first()[0]
    below = (digest < end["priority"]) | ((digest == end["priority"]) & (text <= end["key"]))
    return df.where(below)


def stride_sample(steps: DataFrame, points: int = 500, order: str = TIME) -> DataFrame:
    """Every k-th row by ``order``, with k = max(1, rows // points)."""
    n = steps.agg(F.count(F.lit(1))).scalar()
    rows = with_position(steps, order, name="_pos").withColumn("_n", n)
    stride = F.greatest(F.floor(F.col("_n") / F.lit(points)), F.lit(1))
    return rows.where(F.pmod(F.col("_pos"), stride) == 0).drop("_pos", "_n")


def place_evenly(panel: DataFrame, nodes: int, rows: int, partitions: int = 8) -> DataFrame:
    """Deal a dense panel of ``rows`` cells into equal partitions by key.

    A cell's partition follows from its key, so a retried task gets the same rows
    and the counts per partition are known beforehand.
    """
    index = F.col(TIME) * nodes + F.col(NODE)
    size = -(-rows // partitions) or 1
    place = F.call_function("div", index, F.lit(size)).cast("int")
    return panel.repartitionById(partitions, place)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows in each partition that has any."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition_id"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("partition_id")
    )
