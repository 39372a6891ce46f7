"""Appends that may be repeated: each batch counts once, however often it is written.

A batch is written to a folder of its own that nobody reads yet. A marker named
after the batch, created only if there is none, then makes that folder the
batch's. Whoever comes second, a retry or a second driver, finds the marker and
drops what it wrote. Readers look at marked folders only, so they never see half a
batch. An empty marker is one whose writer died; the next append takes it over.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = "_batches"


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _marked(spark: SparkSession, marker: str) -> bool:
    system, at = _system(spark, marker)
    return system.exists(at) and system.getFileStatus(at).getLen() > 0


def _mark(spark: SparkSession, marker: str, content: str) -> bool:
    """Create the marker, or fill an empty one; False if another writer's is there."""
    system, at = _system(spark, marker)
    try:
        out = system.create(at, system.exists(at))
    except Exception:
        if _marked(spark, marker):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """Batch ids and the folders that hold their rows, from one small file per batch."""
    system, folder = _system(spark, f"{path}/{MARKERS}")
    if not system.exists(folder):
        return {}
    found = [f for f in system.listStatus(folder) if f.getLen() > 0]
    if not found:
        return {}
    rows = spark.read.text([f.getPath().toString() for f in found], wholetext=True)
    folders = [r[0] for r in rows.collect()]
    return {unquote(f.removeprefix("rows/")[:-33]): f for f in folders}


def append_once(rows: DataFrame, path: str, batch: str) -> bool:
    """Add ``rows`` as the named batch. False, and nothing added, if it is there already."""
    spark = rows.sparkSession
    name = quote(batch, safe="")
    if name.strip(".") == "":
        raise ValueError(f"no name for a batch: {batch!r}")
    marker = f"{path}/{MARKERS}/{name}"
    if _marked(spark, marker):
        return False
    folder = f"rows/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    if not _marked(spark, marker) and _mark(spark, marker, folder):
        return True
    system, at = _system(spark, f"{path}/{folder}")
    system.delete(at, True)
    return False


def read_appends(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches, with the id in the column ``batch``.

    Columns go by name, so a later batch may have more. One scan over all folders.
    """
    folders = committed(spark, path)
    if not folders:
        raise ValueError(f"no batch at {path}")
    rows = spark.read.option("mergeSchema", "true").parquet(*[f"{path}/{f}" for f in folders.values()])
    # The file's URI shows the quoted folder name quoted once more.
    name = F.regexp_extract("_metadata.file_path", r"/rows/([^/]+)-[0-9a-f]{32}/[^/]+$", 1)
    return rows.withColumn("batch", F.url_decode(F.url_decode(name)))
