"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns vectors by a pseudo-random rotation (three rounds of random
signs and a fast Hadamard transform) and files every vector under its nearest
signed axis. A query looks up the signed axes nearest to it in every table, and
the candidates met there are ranked by their exact inner product. Rotations are
the whole index: every row is filed in every table.

Vectors are filed by direction alone, so lengths do not blur the angles. They are
also kept in bands of similar length. After the search, a band whose longest vector
could still beat a query's last neighbour at a small cosine, where hashing may miss
it, is compared with the query in full; so is everything for queries that met fewer
than ``k`` candidates.

Large buckets and bands are dealt into salted parts of bounded size, and a query
visits all parts.

Vectors that are NULL, zero, or hold a NULL, NaN or infinite component take no
part. Every row is a candidate of its own, repeated or not; a query never meets rows
of its own id, and queries of one id share one list. NULL ids come last among ties.
Scores beyond the range of doubles are infinite. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.llm.topk import FAN, best, first_k, id_array, matrix, merge, spread, usable
from stpanel.operators.storage import materialize

TABLES = 8
PROBES = 16  # of twice the padded dimension, per table; a quarter of the dimension if that is more
SURE = 0.3  # cosine from which a vector is met in one of the tables with a chance of 95 %
PART = 1024  # vectors in one part of a bucket
BANDS = 3  # bands of length per factor of two
BLOCK = 4096  # queries of one bucket that meet a part together
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = x.shape[1], 1
    while step < width:
        pairs = x.reshape(len(x), width // (2 * step), 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2)
        x = x.reshape(-1, width)
        step *= 2
    return x / np.sqrt(width)


def rotations(width: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """Random signs: (table, round, component)."""
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, width))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    for row in signs:
        x = hadamard(x * row)
    return x


def signed_axes(y: np.ndarray) -> np.ndarray:
    """Closeness of each row to the signed axes +0, -0, +1, -1, ..."""
    return np.stack([y, -y], axis=2).reshape(len(y), -1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in component order: equal vectors give equal scores."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def file_vectors(rows: DataFrame, dim: int, probes: int, tables: int, seed: int) -> DataFrame:
    """``row, vec_id, v, band, table, bucket``: each row in its bucket or, with ``probes``, in its nearest ones."""
    width = 1 << (dim - 1).bit_length()
    signs = rotations(width, tables, seed)
    names = ["row", "vec_id", "v", "band"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dim)
            x = np.zeros((len(v), width))
            x[:, :dim] = v / np.abs(v).max(1, keepdims=True) if len(v) else v
            for table in range(tables):
                near = signed_axes(rotate(x, signs[table]))
                if probes:
                    looked = np.argsort(-near, axis=1, kind="stable")[:, :probes]
                    at, bucket = np.repeat(np.arange(len(v)), looked.shape[1]), looked.ravel()
                else:
                    at, bucket = np.arange(len(v)), near.argmax(1) if len(v) else np.zeros(0)
                part = batch.select(names).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(len(at), table), pa.int32()), pa.array(bucket.astype(np.int32))],
                    [*names, "table", "bucket"],
                )

    kind = rows.schema["v"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, vec_id long, v {kind}, band int, table int, bucket int")


def _search(filed: DataFrame, looked: DataFrame, on: list[str], dim: int, k: int, part: int) -> DataFrame:
    """``query, query_id, row, vec_id, score``: top lists of each part of the buckets, ``on`` which both sides agree."""
    by = ["table", "band", "bucket"]
    sizes = filed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select(*by, F.ceil(F.col("n") / F.lit(part)).cast("int").alias("parts"))
    # Queries of one bucket are dealt out as well: a common vector may be asked for very often.
    asked = looked.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("deals"))
    grid = materialize(parts.join(asked, on), "ann-grid")  # buckets that hold vectors and are asked for
    salt, deal = F.pmod(F.xxhash64("row"), F.col("parts")), F.pmod(F.xxhash64("row", F.lit("deal")), F.col("deals"))
    keys = [*by, "salt", "deal"]
    c = filed.join(grid, by).withColumns({"salt": salt.cast("int"), "deal": F.explode(F.sequence(F.lit(0), F.col("deals") - 1))})
    q = looked.select("row", "vec_id", "v", *on).join(grid, on)
    q = q.withColumns({"deal": deal.cast("int"), "salt": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    c, q = (x.select(*keys, "row", "vec_id", "v") for x in (c, q))

    def bucket(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            a, b = matrix(left["v"], dim), matrix(right["v"], dim)
            own, ids = id_array(left["vec_id"]), id_array(right["vec_id"])
            high = [max(np.abs(x).max(), 1e-300) for x in (a, b)]
            for start in range(0, len(a), 128):
                block = a[start : start + 128]
                scores = (block / high[0]) @ (b / high[1]).T
                at, to = best(scores, ids, own[start : start + 128], k, 1e-12 * dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    score = product(block[at], b[to])
                keep = first_k(at, score, ids[to], k)
                found.append((at[keep] + start, to[keep], score[keep]))
        at, to, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
        at, to = pa.array(at), pa.array(to)
        return pa.table(
            {
                "query": left["row"].take(at), "query_id": left["vec_id"].take(at), "row": right["row"].take(to),
                "vec_id": right["vec_id"].take(to), "score": pa.array(score, pa.float64()),
            }
        )

    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(bucket, "query long, query_id long, row long, vec_id long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    part: int = PART,
    seed: int = SEED,
    sure: float = SURE,
) -> DataFrame:
    """Each query's ``k`` largest inner products among the candidates it meets.

    ``query_id, rank, vec_id, score``.
    """
    high = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    scaled = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("high")) * (x / F.col("high")))
    rows = (
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(embedding).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        )
        .filter(usable("v") & F.exists("v", lambda x: x != 0))
        .withColumn("high", high)
        .withColumn("length", F.log2("high") + 0.5 * F.log2(scaled))  # of any size without overflow
        .select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "v", "q", "length",
            F.floor(F.col("length") * BANDS + 0.5).cast("int").alias("band"),
        )
    )
    rows = materialize(rows, "ann-rows")
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dim = dim or 1
    probes = max(probes, (1 << (dim - 1).bit_length()) // 4)
    filed = materialize(file_vectors(rows, dim, 0, tables, seed), "ann-filed")
    queries = rows.filter("q")
    looked = materialize(file_vectors(queries, dim, probes, tables, seed), "ann-looked")
    # Lists of a query are merged in groups once a query may meet many parts.
    groups = max(1, -(-n // (part * 16)))
    found = materialize(_lists([_search(filed, looked, ["table", "bucket"], dim, k, part)], groups, k), "ann-found")
    # What each band can still hold for each query, in logarithms: lengths and the k-th score.
    bands = [tuple(r) for r in rows.groupBy("band").agg(F.max("length")).collect()]
    reach = F.explode(F.array(*[F.struct(F.lit(b).alias("of"), F.lit(h).alias("longest")) for b, h in bands] or [F.lit(None).cast("struct<of: int, longest: double>")]))
    last = found.groupBy("query").agg(F.count(F.lit(1)).alias("met"), F.min("score").alias("last"))
    few = (F.col("met") < k) | F.col("met").isNull() | (F.col("last") <= 0)
    cosine = F.log2("last") - F.col("length") - F.col("reach.longest")
    open_bands = (
        queries.join(last, F.col("row") == F.col("query"), "left")
        .withColumn("reach", reach)
        .filter(few | ((cosine < F.log2(F.lit(sure))) & (F.lit(sure) < 1)))
    )
    rest = open_bands.select("row", "vec_id", "v", F.col("reach.of").alias("band"), F.lit(0).alias("table"), F.lit(-1).alias("bucket"))
    rest = materialize(rest, "ann-rest")
    whole = filed.filter("table = 0").withColumn("bucket", F.lit(-1))
    lists = [found, _search(whole, rest, ["table", "band", "bucket"], dim, k, part)]
    return merge(_lists(lists, groups, k).withColumn("shard", spread(groups)), k, groups)


def _lists(lists: list[DataFrame], groups: int, k: int) -> DataFrame:
    """The best ``k`` rows that each query met; a row met in several tables is one candidate."""
    rows = reduce(DataFrame.unionByName, lists).dropDuplicates(["query", "row"])
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    while groups > FAN:
        groups = -(-groups // FAN)
        rank = F.row_number().over(Window.partitionBy("query", F.pmod(F.xxhash64("row"), F.lit(groups))).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")
