"""Spark data source ``npy``: dense ``.npy`` arrays on shared storage.

Reading: an array ``(T, N, F)`` or ``(T, N)`` becomes panel rows, ``(n,)`` becomes
``(position, value)``, and with ``layout=edges`` an array ``(2, E)`` becomes
``(src, dst)``. Each input partition reads the byte ranges of one slice, from any
file system Arrow can open, and yields Arrow batches, so no task and no driver
holds the array.

Steps are pruned by ``startStep`` and ``endStep``, not by pushed filters: Spark
keeps a reader whose steps a filter has narrowed for later queries of the same
DataFrame that push nothing, which would lose rows.

Writing: rows of a dense panel, placed in row-major order (``in_tensor_order``),
become one ``(T, N, F)`` array. Each task writes a gapless run of cells at their
place in the file; the file gets its name only after the runs are seen to tile
the whole array. A retried task writes the same bytes again. On storage that is
not mounted (or with ``runs=true``) each task writes a file of its own, and a
manifest, written last, lists them; such a folder is read like an array file. What
Spark's configuration places elsewhere is stored in blocks (``blocks.py``).

Options: ``path``; reading ``layout``, ``features`` (comma-separated names),
``columns`` (the features to return), ``startStep``, ``endStep`` (half-open),
``partitionBytes``; writing ``steps``,
``nodes``, ``dtype``.
"""

from __future__ import annotations

import json
import math
import os
import sys
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
    TimestampNTZType,
)

from stpanel.operators.panel import in_tensor_order
from stpanel.sources.blocks import is_blocks, qualified, read_blocks, write_blocks

PARTITION_BYTES = 128 * 1024 * 1024
BATCH_ROWS = 65_536


def _local(path: str) -> str:
    """Path of a mounted file; the writer needs to write at any position."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"arrays are written to mounted file systems only, not {path}")
    return path.removeprefix("file://").removeprefix("file:")


def _mounted(path: str) -> bool:
    return "://" not in path or path.startswith("file://")


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    return (fs.LocalFileSystem(), _local(path)) if _mounted(path) else fs.FileSystem.from_uri(path)


def _open(path: str) -> pa.NativeFile:
    system, name = _system(path)
    return system.open_input_file(name)


MANIFEST = "manifest.json"


class Runs:
    """The cells of an array stored as one file per run, read like a single file."""

    def __init__(self, path: str, manifest: dict):
        self.path, self.at = path, 0
        size = np.dtype(manifest["dtype"]).itemsize * manifest["shape"][-1]
        self.runs = sorted((first * size, stop * size, name) for first, stop, name in manifest["runs"])
        self.ends = [stop for _, stop, _ in self.runs]

    def __enter__(self) -> Runs:
        return self

    def __exit__(self, *_) -> None:
        pass

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        out = []
        for first, stop, name in self.runs[bisect_right(self.ends, self.at) :]:
            start, end = max(first, self.at), min(stop, self.at + n)
            if start >= end:
                break
            with _open(f"{self.path}/{name}") as file:
                file.seek(start - first)
                out.append(file.read(end - start))
        self.at += n
        return b"".join(out)


def _manifest(path: str) -> dict | None:
    """The manifest of an array stored in runs; None for an array file."""
    system, name = _system(path)
    if system.get_file_info(name).type != fs.FileType.Directory:
        return None
    with _open(f"{path}/{MANIFEST}") as file:
        return json.loads(file.read())


def _array(path: str) -> pa.NativeFile | Runs:
    manifest = _manifest(path)
    return _open(path) if manifest is None else Runs(path, manifest)


@dataclass
class Header:
    """What the head of an array file says, and where its cells begin."""

    shape: tuple[int, ...]
    dtype: np.dtype
    offset: int

    @property
    def ndim(self) -> int:
        return len(self.shape)


def _header(path: str) -> Header:
    parsers = {
        (1, 0): np.lib.format.read_array_header_1_0,
        (2, 0): np.lib.format.read_array_header_2_0,
    }
    manifest = _manifest(path)
    if manifest is not None:
        return Header(tuple(manifest["shape"]), np.dtype(manifest["dtype"]), 0)
    with _open(path) as file:
        shape, by_column, dtype = parsers[np.lib.format.read_magic(file)](file)
        if by_column and len(shape) > 1:
            raise ValueError("arrays must be stored row by row")
        return Header(shape, dtype, file.tell())


def _values(file: pa.NativeFile, header: Header, start: int, stop: int) -> np.ndarray:
    """Cells ``start`` to ``stop`` of the flat array."""
    size = header.dtype.itemsize
    file.seek(header.offset + start * size)
    return np.frombuffer(file.read((stop - start) * size), dtype=header.dtype)


@dataclass
class Slice(InputPartition):
    start: int
    stop: int


class NpySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def _layout(self, array: Header) -> str:
        layout = self.options.get("layout")
        if layout is None:
            layout = "vector" if array.ndim == 1 else "panel"
        wanted = {"vector": (1,), "panel": (2, 3), "edges": (2,)}
        if layout not in wanted or array.ndim not in wanted[layout]:
            raise ValueError(f"layout {layout!r} does not fit an array of {array.ndim} dimensions")
        if layout == "edges" and array.shape[0] != 2:
            raise ValueError(f"edges need shape (2, E), not {array.shape}")
        return layout

    def _features(self, array: Header) -> list[str]:
        n = array.shape[2] if array.ndim == 3 else 1
        given = self.options.get("features")
        names = [s.strip() for s in given.split(",")] if given else [f"f{i}" for i in range(n)]
        if len(names) != n:
            raise ValueError(f"{len(names)} feature names for {n} features")
        return names

    def _columns(self, features: list[str]) -> list[str]:
        """The features to return, in the order of the array."""
        given = self.options.get("columns")
        chosen = [s.strip() for s in given.split(",")] if given else features
        if not set(chosen) <= set(features):
            raise ValueError(f"no such features: {sorted(set(chosen) - set(features))}")
        return [f for f in features if f in chosen]

    def schema(self) -> StructType:
        array = _header(self.options["path"])
        layout = self._layout(array)
        if layout == "panel":
            keys = [StructField("time_step", LongType()), StructField("node_id", IntegerType())]
            chosen = self._columns(self._features(array))
            return StructType(keys + [StructField(c, DoubleType()) for c in chosen])
        if layout == "edges":
            return StructType([StructField("src", LongType()), StructField("dst", LongType())])
        if array.dtype.kind == "M":
            value = TimestampNTZType()
        elif array.dtype.kind in "iu":
            value = LongType()
        else:
            value = DoubleType()
        return StructType([StructField("position", LongType()), StructField("value", value)])

    def reader(self, schema: StructType) -> NpyReader:
        array = _header(self.options["path"])
        layout = self._layout(array)
        features = self._features(array) if layout == "panel" else []
        return NpyReader(dict(self.options), layout, schema.names, features)

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        options = dict(self.options)
        if _mounted(options["path"]) and options.get("runs") != "true":
            return NpyWriter(options, schema.names, overwrite)
        return RunsWriter(options, schema.names, overwrite)


class NpyReader(DataSourceReader):
    def __init__(self, options: dict, layout: str, names: list[str], features: list[str]):
        self.path = options["path"]
        self.layout = layout
        self.names = names
        self.all = features
        self.first = int(options.get("startStep", options.get("startstep", 0)))
        end = options.get("endStep", options.get("endstep"))
        self.end = None if end is None else int(end)
        self.bytes = int(
            options.get("partitionBytes", options.get("partitionbytes", PARTITION_BYTES))
        )

    def partitions(self) -> list[Slice]:
        array = _header(self.path)
        length = array.shape[1] if self.layout == "edges" else array.shape[0]
        stop = length if self.end is None else min(self.end, length)
        start = max(self.first, 0)
        per_item = array.dtype.itemsize * math.prod(array.shape) // max(1, length)
        count = max(1, self.bytes // max(1, per_item))
        slices = [Slice(i, min(i + count, stop)) for i in range(start, stop, count)]
        return slices or [Slice(start, start)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        """Batches of at most BATCH_ROWS rows, also within one wide time step."""
        array = _header(self.path)
        nodes = array.shape[1] if self.layout == "panel" else 1
        make = {"panel": self._panel, "edges": self._edges, "vector": self._vector}[self.layout]
        with _array(self.path) as file:
            for at in range(partition.start * nodes, partition.stop * nodes, BATCH_ROWS):
                to = min(at + BATCH_ROWS, partition.stop * nodes)
                cols = make(file, array, at, to)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=self.names)

    def _panel(self, file, array: Header, at: int, to: int) -> list[np.ndarray]:
        nodes = array.shape[1]
        width = array.shape[2] if array.ndim == 3 else 1
        wanted = [i for i, c in enumerate(self.all) if c in self.names]
        index = np.arange(at, to, dtype="int64")
        cells = _values(file, array, at * width, to * width).reshape(-1, width)
        by_feature = np.ascontiguousarray(cells.T[wanted], dtype="float64")
        return [(index // nodes).astype("int64"), (index % nodes).astype("int32"), *by_feature]

    def _edges(self, file, array: Header, at: int, to: int) -> list[np.ndarray]:
        ends = [
            _values(file, array, row * array.shape[1] + at, row * array.shape[1] + to)
            for row in (0, 1)
        ]
        return [end.astype("int64") for end in ends]

    def _vector(self, file, array: Header, at: int, to: int) -> list[np.ndarray]:
        values = _values(file, array, at, to)
        kinds = {"M": "datetime64[us]", "i": "int64", "u": "int64"}
        return [
            np.arange(at, to, dtype="int64"),
            values.astype(kinds.get(values.dtype.kind, "float64")),
        ]


@dataclass
class Written(WriterCommitMessage):
    first: int
    stop: int
    name: str = ""


class CellsWriter(DataSourceArrowWriter):
    """Checks that every task gets a gapless run of cells, and all runs the array."""

    def __init__(self, options: dict, names: list[str]):
        self.steps, self.nodes = int(options["steps"]), int(options["nodes"])
        self.features = [c for c in names if c not in ("time_step", "node_id")]
        self.dtype = np.dtype(options.get("dtype", "float32"))

    def _cells(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """First cell and values (cell, feature) of each batch."""
        stop = -1
        for batch in iterator:
            if batch.num_rows == 0:
                continue
            steps = batch.column("time_step").to_numpy(zero_copy_only=False).astype("int64")
            nodes = batch.column("node_id").to_numpy(zero_copy_only=False).astype("int64")
            index = steps * self.nodes + nodes
            at = int(index[0]) if stop < 0 else stop
            if nodes.max() >= self.nodes or not np.array_equal(
                index, np.arange(at, at + len(index))
            ):
                raise ValueError(f"missing, repeated or unordered cells after cell {at}")
            stop = at + len(index)
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in self.features]
            yield at, np.stack(columns, axis=1).astype(self.dtype)

    def _tiling(self, messages: list[Written | None]) -> list[Written]:
        """The runs in order, seen to hold every cell once."""
        runs = sorted((m for m in messages if m and m.stop >= 0), key=lambda m: m.first)
        end = 0
        for run in runs:
            if run.first != end:
                break
            end = run.stop
        if end != self.steps * self.nodes:
            self.abort(messages)
            raise ValueError(f"the panel is not dense: no single row for cell {end}")
        return runs


class RunsWriter(CellsWriter):
    """One file per task and a manifest, on any storage Arrow can open."""

    def __init__(self, options: dict, names: list[str], overwrite: bool):
        super().__init__(options, names)
        self.path, self.job = options["path"], uuid.uuid4().hex
        system, name = _system(self.path)
        if system.get_file_info(name).type != fs.FileType.NotFound and not overwrite:
            raise ValueError(f"{self.path} exists")
        system.create_dir(name, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        first = stop = -1
        name, file = f"{self.job}-{uuid.uuid4().hex}.run", None
        system, folder = _system(self.path)
        for at, cells in self._cells(iterator):
            if file is None:
                first, file = at, system.open_output_stream(f"{folder}/{name}")
            file.write(cells.tobytes())
            stop = at + len(cells)
        if file is not None:
            file.close()
        return Written(first, stop, name)

    def commit(self, messages: list[Written | None]) -> None:
        manifest = {
            "shape": [self.steps, self.nodes, len(self.features)],
            "dtype": self.dtype.str,
            "runs": [[m.first, m.stop, m.name] for m in self._tiling(messages)],
        }
        system, folder = _system(self.path)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as file:
            file.write(json.dumps(manifest).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Runs without a manifest are never read; those that are known go."""
        system, folder = _system(self.path)
        for m in messages:
            if m is not None and m.stop >= 0:
                system.delete_file(f"{folder}/{m.name}")


class NpyWriter(CellsWriter):
    """One array file on a mounted file system; each task writes its place in it."""

    def __init__(self, options: dict, names: list[str], overwrite: bool):
        super().__init__(options, names)
        self.path = _local(options["path"])
        if os.path.exists(self.path) and not overwrite:
            raise ValueError(f"{self.path} exists")
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        shape = (self.steps, self.nodes, len(self.features))
        np.lib.format.open_memmap(self.part, mode="w+", dtype=self.dtype, shape=shape).flush()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        array = np.lib.format.open_memmap(self.part, mode="r+")
        flat = array.reshape(self.steps * self.nodes, len(self.features))
        first = stop = -1
        for at, cells in self._cells(iterator):
            first = at if first < 0 else first
            stop = at + len(cells)
            flat[at:stop] = cells
        array.flush()
        return Written(first, stop)

    def commit(self, messages: list[Written | None]) -> None:
        self._tiling(messages)
        os.replace(self.part, self.path)

    def abort(self, messages: list[Written | None]) -> None:
        if os.path.exists(self.part):
            os.remove(self.part)


def register(spark: SparkSession) -> None:
    """Make the format known; executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(NpySource)


def _shared(spark: SparkSession, path: str) -> str | None:
    """The full path, if Spark does not take it for a mounted folder's."""
    full = qualified(spark, path)
    return None if full.startswith("file:") else full


def read_npy(spark: SparkSession, path: str, **options) -> DataFrame:
    """Panel, vector or edges of an array; see the options at the top.

    Arrays stored in blocks take ``features``, ``columns``, ``startStep`` and ``endStep``.
    """
    if is_blocks(spark, path):
        names = {k: [s.strip() for s in options[k].split(",")] for k in ("features", "columns") if options.get(k)}
        end = options.get("endStep")
        return read_blocks(spark, path, **names, start=int(options.get("startStep", 0)), end=None if end is None else int(end))
    register(spark)
    return spark.read.format("npy").options(**options).load(path)


def write_npy(
    panel: DataFrame, path: str, steps: int, nodes: int, dtype: str = "float32", runs: bool = False
) -> None:
    """Write a dense panel as one array; each task writes one run of cells.

    A path on a mounted file system becomes one array file (or, with ``runs``, a
    file per task). Any other path, also one without a scheme where the cluster's
    default file system is not the local one, is written in blocks by Spark.
    """
    full = _shared(panel.sparkSession, path)
    if full is not None and not runs:
        write_blocks(panel, full, steps, nodes, dtype)
        return
    register(panel.sparkSession)
    ordered = in_tensor_order(panel, steps, nodes)
    ordered.write.format("npy").mode("overwrite").options(
        steps=steps, nodes=nodes, dtype=dtype, runs=str(runs).lower()
    ).save(full or path)
