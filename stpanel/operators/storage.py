"""Shared scratch storage and the join policy for lookup tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only below this size, computed from its real row
# count and the widths of its columns.
MAX_BROADCAST_BYTES = 64 << 20
WIDTHS = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4,
    "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8,
}

_made: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset: a folder of the session's warehouse if there is only this
    machine, else one of the user's home on the cluster's default file system.
    Never a machine-local folder on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{system.getHomeDirectory().toString()}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder; never an existing one.

    It belongs to the query that asked for it and lives until ``release``.
    """
    path = f"{scratch_root(spark)}/stpanel/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the scratch tables made so far, once the results read from them are done."""
    while _made:
        _delete(spark, _made.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the scratch tables made inside the block when it ends, and no others.

    Write or collect the result inside, or hand a materialized one to the function
    that the block is given: it outlives the block. What other results read is gone.
    """
    before, kept = len(_made), []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table._scratch_path)
        return table

    try:
        yield keep
    finally:
        inside = _made[before:]
        del _made[before:]
        for path in inside:
            if path in kept:
                _made.append(path)
            else:
                _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame) -> None:
    """Delete a table made by ``materialize`` that nothing will read again."""
    _delete(table.sparkSession, table._scratch_path)
    _made.remove(table._scratch_path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a result once and read it back.

    Cuts the lineage at a durable table, so a lost executor re-reads files
    instead of recomputing, and gives the planner the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a DataFrame in memory, spilling to disk, while the block runs.

    For interactive reuse; a lost executor recomputes its part. Use
    ``materialize`` where the lineage is long.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def attach(
    big: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join a keyed lookup table to a large table.

    Pass a stored lookup: its rows are counted from the file footers. If all its
    columns have a fixed width and the table fits, it is broadcast. Otherwise,
    and always for strings, arrays and structs, whose width is not known, the
    planner decides from the real sizes, and hot keys are left to the adaptive
    skew join.
    """
    widths = [WIDTHS.get(kind) for _, kind in lookup.dtypes]
    if None not in widths and lookup.count() * sum(widths) <= max_bytes:
        lookup = F.broadcast(lookup)
    return big.join(lookup, on, how)
