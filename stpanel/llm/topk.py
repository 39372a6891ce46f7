"""Exact top-k inner products by tiles.

Queries are dealt into blocks and candidates into shards, both of bounded size.
Every (block, shard) pair is one tile: a matrix product and a partial selection
of each query's best. The lists of the tiles are merged by a tree of bounded
fan-in, so no task holds more than ``FAN * k`` rows of a query.

Vectors that are NULL or hold a NULL, NaN or infinite component take no part;
shorter vectors count as padded with zeros. Rows with equal ids are separate
candidates; a query never meets rows of its own id, and queries of one id share
one list. NULL ids are candidates after all others. Ties go to the smaller id.
Without candidates a query has no row; without rows the result is empty.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192  # queries in a block
SHARD = 2048  # candidates in a shard
FAN = 32  # lists merged at once
_NO_ID = np.iinfo(np.int64).max


def usable(vector: str) -> Column:
    """Whether a vector has only finite components and is not NULL."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def id_array(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy().astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, slack: float = 0.0):
    """Positions (query, candidate) of each query's ``k`` best, ties at the end included.

    With ``slack`` also those that a rounding error of that size may hide.
    """
    scores = np.where(own[:, None] == ids[None, :], -np.inf, scores)
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        chosen = scores >= edge[:, None] - slack
    else:
        chosen = np.ones(scores.shape, bool)
    return np.nonzero(chosen & (scores > -np.inf))


def first_k(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each query by score, then id."""
    falling = ~score if score.dtype.kind == "i" else -score
    order = np.lexsort((ids, falling, query))
    start = np.r_[True, query[order][1:] != query[order][:-1]]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[rank < k]


EXACT = 2**53  # whole numbers up to here are exact as doubles
MOST = 2**63 - 1


def whole(x: float, factor: int) -> int:
    """floor(factor * x) exactly, for any finite x."""
    return math.floor(Fraction(x) * factor)


def integer_products(a: np.ndarray, b: np.ndarray, factor: int) -> np.ndarray:
    """Exact inner products of rows of whole parts; beyond BIGINT they stop at its ends."""
    whole_rows = [[[whole(x, factor) for x in row] for row in side] for side in (a, b)]
    sums = (sum(x * y for x, y in zip(u, v, strict=True)) for u, v in zip(*whole_rows, strict=True))
    return np.array([max(-MOST - 1, min(MOST, s)) for s in sums], np.int64)


def search_tile(q_ids, queries, c_ids, candidates, k, factor=1, rows=128) -> pa.Table:
    """Best candidates of each query by the integer product of ``floor(factor * x)``.

    Products of doubles are exact while their sums stay below EXACT. Larger ones
    only choose pairs, with room for rounding, that are then scored exactly.
    """
    with np.errstate(over="ignore"):
        a, b = np.floor(factor * queries), np.floor(factor * candidates)
    high = [max(1.0, np.abs(x).max(initial=1.0)) for x in (a, b)]
    exact = high[0] * high[1] * a.shape[1] < EXACT if len(a) else True
    slack = 0.0
    if not exact:
        high = [max(1.0, np.abs(x).max(initial=1.0)) for x in (queries, candidates)]
        a, b, slack = queries / high[0], candidates / high[1], 1e-12 * a.shape[1] + (1 / high[0] + 1 / high[1]) * a.shape[1] / factor
    found = []
    for start in range(0, len(q_ids), rows):
        block, own = a[start : start + rows], q_ids[start : start + rows]
        scores = block @ b.T
        at, to = best(scores, c_ids, own, k, slack)
        if exact:
            score = scores[at, to].astype(np.int64)
        else:
            score = integer_products(queries[start : start + rows][at], candidates[to], factor)
        keep = first_k(at, score, c_ids[to], k)
        found.append((own[at[keep]], c_ids[to[keep]], score[keep]))
    q, c, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else ([], [], [])
    c = np.asarray(c, np.int64)
    return pa.table(
        {"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64(), mask=c == _NO_ID), "score": pa.array(s, pa.int64())}
    )


def merge(lists: DataFrame, k: int, parts: int, part: str = "shard") -> DataFrame:
    """Merge top lists of ``parts`` parts into ``query_id, rank, vec_id, score``."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    while parts > FAN:
        parts = -(-parts // FAN)
        lists = lists.withColumn(part, F.col(part) % parts)
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", part).orderBy(*order)))
        lists = lists.filter(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def spread(parts: int, *extra: Column) -> Column:
    """An even part number from a hash of the id."""
    return F.pmod(F.xxhash64("vec_id", *extra), F.lit(parts)).cast("int")


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    factor: int = 64,
) -> DataFrame:
    """Each query's ``k`` highest integer inner products: ``query_id, rank, vec_id, score``.

    Components become ``floor(factor * x)``. Products are exact at any size; a
    score beyond the range of BIGINT is its largest or smallest number.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"), is_query.alias("q"))
    rows = rows.filter(usable("v"))
    n, width, asked = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("q")).first()
    shards, blocks, width = max(1, -(-n // SHARD)), max(1, -(-asked // BLOCK)), width or 1
    # A candidate goes to its shard's tile of every block, a query to its block's tile of every shard.
    c = rows.select("vec_id", "v", spread(shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    q = rows.filter("q").select(F.col("vec_id").alias("query_id"), F.col("v").alias("w"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), spread(blocks, F.lit("block")).alias("block"))

    def tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return search_tile([], [], np.zeros(0, np.int64), [], k).append_column("shard", pa.array([], pa.int32()))
        out = search_tile(id_array(left["query_id"]), matrix(left["w"], width), id_array(right["vec_id"]), matrix(right["v"], width), k, factor)
        return out.append_column("shard", pa.array(np.full(out.num_rows, key[0].as_py()), pa.int32()))

    lists = (
        q.groupBy("shard", "block")
        .cogroup(c.groupBy("shard", "block"))
        .applyInArrow(tile, "query_id long, vec_id long, score long, shard int")
    )
    return merge(lists, k, shards)
