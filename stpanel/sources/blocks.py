"""Dense arrays as blocks in Parquet, on any file system that Spark itself can open.

A row is one block: the flat index of its first cell, its number of cells, and
their values as bytes in row-major order. Blocks start at multiples of
``BLOCK_CELLS`` wherever a task's run of cells allows. Spark writes and lists the
files, so a path without a scheme means the cluster's default file system, and a
range of steps becomes a filter on the first cell that skips row groups. A small
file, written last, names shape, type and features; without it there is no array.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.operators.panel import NODE, TIME, in_tensor_order

BLOCK_CELLS = 65_536
HEAD = "array.json"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark's configuration gives it."""
    system, target = _file_system(spark, path)
    return system.makeQualified(target).toString()


def is_blocks(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, f"{path}/{HEAD}")
    return system.exists(target)


def write_blocks(panel: DataFrame, path: str, steps: int, nodes: int, dtype: str = "float32") -> None:
    """Write a dense panel. Raises, and leaves no array, if a cell is missing or repeated."""
    spark = panel.sparkSession
    features = [c for c in panel.columns if c not in (TIME, NODE)]
    kind = np.dtype(dtype)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = stop = None
        held: list[np.ndarray] = []

        def block(cells: np.ndarray, at: int) -> pa.RecordBatch:
            columns = [pa.array([at]), pa.array([len(cells)], pa.int32()), pa.array([cells.astype(kind).tobytes()])]
            return pa.RecordBatch.from_arrays(columns, ["first", "cells", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            step, node = (batch.column(c).to_numpy(zero_copy_only=False).astype("int64") for c in (TIME, NODE))
            index = step * nodes + node
            first, stop = (int(index[0]), int(index[0])) if stop is None else (first, stop)
            if node.max() >= nodes or not np.array_equal(index, np.arange(stop, stop + len(index))):
                raise ValueError(f"missing, repeated or unordered cells after cell {stop}")
            stop += len(index)
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features], axis=1))
            while stop // BLOCK_CELLS > first // BLOCK_CELLS:
                cells, cut = np.concatenate(held), (first // BLOCK_CELLS + 1) * BLOCK_CELLS - first
                yield block(cells[:cut], first)
                first, held = first + cut, [cells[cut:]]
        if held and first < stop:
            yield block(np.concatenate(held), first)

    rows = panel.select(TIME, NODE, *[F.col(c).cast("double").alias(c) for c in features])
    system, head = _file_system(spark, f"{path}/{HEAD}")
    if system.exists(head):
        system.delete(head, False)
    blocks = in_tensor_order(rows, steps, nodes).mapInArrow(pack, "first long, cells int, data binary")
    blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    stored = spark.read.parquet(f"{path}/blocks").agg(F.sum("cells"), F.max(F.col("first") + F.col("cells"))).first()
    # Each run is gapless, and runs hold different keys: the sum tells whether all cells are there.
    if (stored[0] or 0, stored[1] or 0) != (steps * nodes,) * 2:
        raise ValueError(f"the panel is not dense: {stored[0] or 0} of {steps * nodes} cells")
    told = {"shape": [steps, nodes, len(features)], "dtype": kind.str, "features": features}
    out = system.create(head, True)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()


def read_blocks(
    spark: SparkSession,
    path: str,
    features: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    start: int = 0,
    end: int | None = None,
) -> DataFrame:
    """Panel rows of the steps ``start <= time_step < end``, with the chosen features.

    ``features`` renames all features in order, ``columns`` picks some of them.
    """
    told = json.loads(spark.read.text(f"{path}/{HEAD}", wholetext=True).first()[0])
    (steps, nodes, width), kind = told["shape"], np.dtype(told["dtype"])
    names = list(features or told["features"])
    if len(names) != width:
        raise ValueError(f"{len(names)} feature names for {width} features")
    chosen = [c for c in names if columns is None or c in columns]
    if columns is not None and len(chosen) != len(set(columns)):
        raise ValueError(f"no such features: {sorted(set(columns) - set(names))}")
    low, high = max(start, 0) * nodes, min(steps if end is None else end, steps) * nodes
    wanted = [names.index(c) for c in chosen]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column("first").to_pylist(), batch.column("data").to_pylist(), strict=True):
                cells = np.frombuffer(data, kind).reshape(-1, width)
                index = np.arange(at, at + len(cells), dtype="int64")
                inside = slice(max(low - at, 0), max(high - at, 0))
                index, cells = index[inside], cells[inside]
                values = [pa.array(np.ascontiguousarray(cells[:, i], dtype="float64")) for i in wanted]
                keys = [pa.array(index // nodes), pa.array((index % nodes).astype("int32"))]
                yield pa.RecordBatch.from_arrays([*keys, *values], [TIME, NODE, *chosen])

    near = (F.col("first") < high) & (F.col("first") > low - BLOCK_CELLS)
    blocks = spark.read.parquet(f"{path}/blocks").where(near).select("first", "data")
    return blocks.mapInArrow(unpack, ", ".join([f"{TIME} long", f"{NODE} int", *[f"`{c}` double" for c in chosen]]))
