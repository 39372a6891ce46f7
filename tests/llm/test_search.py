import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stpanel.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, score int, shard int"
NAN, INF = float("nan"), float("inf")


def fixture(seed, n=240, dim=10):
    r = random.Random(seed)
    rows = [(i, [r.choice([-0.5, 0.25, 0.125, 1.0, r.random()]) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)]
    rows += [(1000, None), (1020, [1.0, None] * 5), (1040, [NAN] * 10), (1060, [INF] * 10), (1080, [0.0] * 10), (None, rows[4][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, 0, 1) for x in rows], SCHEMA)


def query():
    return F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False))


def brute(rows, score, k=20, zero=True):
    good = [(i, np.float32(v).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    good = [(i, v) for i, v in good if zero or v.any()]
    out = []
    for i, v in good:
        if i is not None and i % 20 == 0:
            found = sorted(((-score(v, w), j is None, j or 0) for j, w in good if j != i))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out)


def integer(v, w):
    return int(np.floor(64 * v) @ np.floor(64 * w))


def doubles(v, w):
    total = 0.0
    for a, b in zip(v, w, strict=True):
        total += a * b
    return total


@pytest.mark.parametrize("seed", range(2))
def test_exact_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "FAN", 3)
    rows = fixture(seed)
    got = sorted(tuple(r) for r in topk.exact_top_k(frame(spark, rows), query()).collect())
    assert got == brute(rows, integer)


@pytest.mark.parametrize("rows", [[], [(0, [1.0] * 10)], [(0, [1.0] * 10), (3, [0.5] * 10), (20, None)]])
def test_few_rows(spark, rows):
    got = sorted(tuple(r) for r in topk.exact_top_k(frame(spark, rows), query()).collect())
    assert got == brute(rows, integer)
    got = sorted(tuple(r) for r in ann.nearest(frame(spark, rows), query()).collect())
    assert got == brute(rows, doubles, zero=False)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.1"])
def test_recall(spark, name):
    vectors = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = [(r[0], list(r[1])) for r in vectors.select("vec_id", "embedding").collect()]
    true = brute(rows, lambda v, w: float(v @ w))
    got = [tuple(r) for r in ann.nearest(vectors, query()).collect()]
    assert sorted((q, r) for q, r, _, _ in got) == [(q, r) for q, r, _, _ in true]
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in true}
    assert len(hits) >= 0.9 * len(true)
    vec = {i: np.float32(v).astype(float) for i, v in rows}
    for q, _, v, s in got:
        assert s == doubles(vec[q], vec[v])
    for q in {g[0] for g in got}:
        mine = sorted((g for g in got if g[0] == q), key=lambda g: g[1])
        assert mine == sorted(mine, key=lambda g: (-g[3], g[2]))


def test_all_buckets_give_the_exact_result(spark):
    rows = fixture(5)
    got = sorted(tuple(r) for r in ann.nearest(frame(spark, rows), query(), probes=64, part=30).collect())
    assert got == brute(rows, doubles, zero=False)


def test_unequal_lengths(spark):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=16) * r.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(600)]
    true = brute(rows, doubles)
    got = {(q, v) for q, _, v, _ in (tuple(x) for x in ann.nearest(frame(spark, rows), query()).collect())}
    assert len(got & {(q, v) for q, _, v, _ in true}) >= 0.9 * len(true)


def test_large_components_are_exact(spark):
    """Beyond 2**53 the sums are whole numbers still; beyond BIGINT they stop."""
    r = random.Random(8)
    rows = [(i, [float(r.choice([1, -1]) * r.randint(0, 2**e)) + 0.3 for e in (3, 20, 24, 18)]) for i in range(120)]
    rows += [(200 + i, [float(2**26 + i), 1.0, 2.0**26, -3.5]) for i in range(30)] + [(300, [1e20, -1e20, 0.0, 1.0]), (301, [1e308, 1e300, 0.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    score = lambda v, w: sum(topk.whole(a, 64) * topk.whole(b, 64) for a, b in zip(v, w, strict=True))
    want = []
    for i, v in rows:
        if i % 20 == 0:
            found = sorted((-max(-(2**63), min(2**63 - 1, score(v, w))), j) for j, w in rows if j != i)[:20]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    assert sorted(tuple(x) for x in topk.exact_top_k(docs, query()).collect()) == want


def clustered(kind, n=4000, dim=64):
    r = np.random.default_rng(12)
    centres = r.normal(size=(80, dim))
    x = centres[r.integers(0, 80, n)] + 0.5 * r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "one long":
        x[7] *= 10
    elif kind == "some long":
        x[r.choice(n, n // 100, replace=False)] *= 10
    elif kind == "spread":
        x *= np.exp(0.5 * r.normal(size=(n, 1)))
    return x.astype(np.float32)


@pytest.mark.parametrize("kind", ["equal", "one long", "some long", "spread"])
def test_recall_at_unequal_lengths(spark, kind):
    x = clustered(kind)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in ann.nearest(docs, query()).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = total = 0
    for i in range(0, len(x), 20):
        scores = x.astype(float) @ x[i].astype(float)
        scores[i] = -np.inf
        hits, total = hits + len(got[i] & set(np.argsort(-scores)[:20].tolist())), total + 20
    assert hits >= 0.9 * total


def test_repeated_rows_are_candidates_of_their_own(spark):
    rows = [(0, [1.0, 0.5]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [0.5, 0.5]), (20, [1.0, 0.0]), (20, [1.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in topk.exact_top_k(docs, query()).collect())
    near = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(docs, query()).collect())
    assert exact == near
    assert [v for q, _, v in near if q == 0] == [3, 3, 20, 20, 4]


def test_enormous_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in ann.nearest(docs, query()).orderBy("rank").collect()]
    assert got == [(1, INF), (3, 2e200), (2, 2.0)]


def test_hadamard_is_orthogonal():
    h = ann.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and math.isclose(abs(h[3, 5]), 0.25)
