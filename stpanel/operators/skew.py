"""Equi-joins in which single keys hold many rows, and groupings of many keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stpanel.operators.storage import attach, materialize

BOUND = 100_000  # rows of a key that go to one task
GROUPED = 500_000  # rows that a task groups


def dealt(rows: DataFrame, count: int, *on: str) -> DataFrame:
    """``rows``, of which there are ``count``, dealt by their keys for a grouping by them.

    A task's table of keys then has about ``GROUPED`` rows at any size of the input.
    Left to itself, Spark fills it by bytes of compressed shuffle or of a file's split.
    Meant for keys that repeat little: all rows of a key travel, to one task.
    """
    return rows.repartition(max(1, -(-count // GROUPED)), *on)


def hub_blocks(big: DataFrame, on: str, bound: int = BOUND) -> DataFrame:
    """``on, _blocks`` of keys with more than ``bound`` rows: at most rows / bound keys."""
    sizes = big.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound)
    return materialize(sizes.select(on, F.ceil(F.col("_n") / F.lit(bound)).cast("int").alias("_blocks")), "hubs")


def hub_join(big: DataFrame, lookup: DataFrame, on: str, bound: int = BOUND) -> DataFrame:
    """Inner equi-join in which no key brings more than about ``bound`` rows to a task.

    The rows of a larger key are dealt into blocks by a hash of the whole row, and
    its lookup row is copied to as many: all in all at most rows / bound copies. A
    lookup that the planner can broadcast needs no blocks and is joined as it is.
    """
    hubs = hub_blocks(big, on, bound)
    if hubs.isEmpty():
        return big.join(lookup, on)
    place = F.pmod(F.xxhash64(*big.columns), F.coalesce("_blocks", F.lit(1))).cast("int")
    dealt = attach(big, hubs, on, "left").withColumn("_block", place).drop("_blocks")
    copies = F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)
    copied = attach(lookup, hubs, on, "left").withColumn("_block", F.explode(copies)).drop("_blocks")
    return dealt.join(copied, [on, "_block"]).drop("_block")
