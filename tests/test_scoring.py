import numpy as np
import pytest
from pyspark.sql import functions as F

from stpanel.operators import graph as G
from stpanel.operators import scoring as S
from stpanel.operators import skew
from stpanel.operators.scaling import fit
from stpanel.operators.skew import hub_blocks, hub_join
from stpanel.operators.storage import discard, materialize, scratch
from tests.test_panel import cube


@pytest.fixture(scope="module")
def case(spark):
    """Forecast, truth (B, H, N) around 300 with weights and climatology."""
    rng = np.random.default_rng(7)
    true = 300 + rng.normal(0, 8, (40, 3, 6)) + np.arange(6) * 4
    pred = true + rng.normal(0, 3, true.shape)
    weights = np.cos(np.radians(np.linspace(-40, -10, 6)))
    weights /= weights.mean()
    clim = true.mean(axis=(0, 1)) + rng.normal(0, 0.5, 6)
    rows = [
        (b, h + 1, n, float(pred[b, h, n]), float(true[b, h, n]))
        for b, h, n in np.ndindex(*true.shape)
    ]
    df = spark.createDataFrame(
        rows, "sample_id long, horizon int, node_id int, pred double, true double"
    )
    nodes = spark.createDataFrame(
        [(n, float(weights[n]), float(clim[n])) for n in range(6)],
        "node_id int, lat_weight double, clim double",
    )
    return pred, true, weights, clim, df, nodes


def by_horizon(df, col):
    return [row[col] for row in df.orderBy("horizon").collect()]


def test_weighted_scores(case):
    pred, true, w, clim, df, nodes = case
    got = S.weighted_scores(df, nodes, nodes)
    rmse = np.sqrt((((pred - true) ** 2) * w).mean(axis=(0, 2)))
    a, b = pred - clim, true - clim
    a = a - a.mean(axis=(0, 2), keepdims=True)
    b = b - b.mean(axis=(0, 2), keepdims=True)
    total = lambda x: (x * w).sum(axis=(0, 2))
    acc = total(a * b) / (np.sqrt(total(a * a) * total(b * b)) + 1e-6)
    assert by_horizon(got, "rmse_w") == pytest.approx(rmse.tolist(), rel=1e-9)
    assert by_horizon(got, "acc_w") == pytest.approx(acc.tolist(), rel=1e-9)
    assert by_horizon(S.weighted_rmse(df, nodes), "rmse_w") == pytest.approx(rmse.tolist())
    assert by_horizon(S.weighted_acc(df, nodes, nodes), "acc_w") == pytest.approx(acc.tolist())
    mean = S.horizon_mean(got, ["rmse_w", "acc_w"]).first()
    assert mean["avg_rmse_w"] == pytest.approx(rmse.mean())
    assert mean["avg_acc_w"] == pytest.approx(acc.mean())


def test_acc_without_climatology_and_of_the_truth(case, spark):
    pred, true, w, _, df, nodes = case
    zero = nodes.withColumn("clim", F.lit(0.0))
    a, b = (x - x.mean(axis=(0, 2), keepdims=True) for x in (pred, true))
    total = lambda x: (x * w).sum(axis=(0, 2))
    acc = total(a * b) / (np.sqrt(total(a * a) * total(b * b)) + 1e-6)
    assert by_horizon(S.weighted_acc(df, nodes, zero), "acc_w") == pytest.approx(
        acc.tolist(), rel=1e-8
    )
    perfect = df.withColumn("pred", F.col("true"))
    assert by_horizon(S.weighted_acc(perfect, nodes, nodes), "acc_w") == pytest.approx([1] * 3)


def test_correlation_and_bundle(case):
    pred, true, _, _, df, _ = case
    p, y = pred - pred.mean(axis=0), true - true.mean(axis=0)
    pearson = (p * y).mean(axis=0) / (pred.std(axis=0) * true.std(axis=0))
    assert by_horizon(S.correlation(df), "corr") == pytest.approx(pearson.mean(axis=1).tolist())
    sample = (p * y).mean(axis=0) / (pred.std(axis=0, ddof=1) * true.std(axis=0, ddof=1))
    assert by_horizon(S.correlation(df, ddof=1), "corr") == pytest.approx(
        sample.mean(axis=1).tolist()
    )
    bundle = S.metric_bundle(df, mask=305.0)
    for h, row in enumerate(bundle.orderBy("horizon").collect()):
        keep = true[:, h] > 305
        e, t = (pred[:, h] - true[:, h])[keep], true[:, h][keep]
        assert row["mse"] == pytest.approx((e**2).mean())
        assert row["rrse"] == pytest.approx(
            np.sqrt((e**2).sum()) / np.sqrt(((t - t.mean()) ** 2).sum()), rel=1e-9
        )
        assert row["corr"] == pytest.approx(pearson[h].mean())
        assert row["mape"] == pytest.approx(np.abs((true - pred) / true)[:, h].mean())


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e6, 1e8])
def test_scores_keep_their_digits_on_large_offsets(spark, offset):
    """Against the plain formulas, which take the means off first."""
    rng = np.random.default_rng(3)
    true = rng.normal(0, 1, (100, 2, 10)) + np.sin(np.arange(10))
    pred = true + rng.normal(0, 1.2, true.shape)
    w = rng.uniform(0.5, 1.5, 10)
    shifted = [(b, h + 1, n, float(pred[b, h, n] + offset), float(true[b, h, n] + offset)) for b, h, n in np.ndindex(*true.shape)]
    df = spark.createDataFrame(shifted, "sample_id long, horizon int, node_id int, pred double, true double")
    nodes = spark.createDataFrame([(n, float(w[n]), 0.0) for n in range(10)], "node_id int, lat_weight double, clim double")
    p, y = (np.array([r[i] for r in shifted]).reshape(true.shape) - offset for i in (3, 4))
    a, b = (x - x.mean(axis=(0, 2), keepdims=True) for x in (p, y))
    total = lambda x: (x * w).sum(axis=(0, 2))
    acc = total(a * b) / (np.sqrt(total(a * a) * total(b * b)) + 1e-6)
    error = np.sqrt(((p - y) ** 2).sum(axis=(0, 2)))
    centre = y.mean(axis=(0, 2), keepdims=True)
    rrse = {name: error / np.sqrt(((x - centre) ** 2).sum(axis=(0, 2))) for name, x in (("truth", y), ("forecast", p))}
    assert by_horizon(S.weighted_acc(df, nodes, nodes), "acc_w") == pytest.approx(acc.tolist(), rel=1e-6)
    assert by_horizon(S.metric_bundle(df), "rrse") == pytest.approx(rrse["truth"].tolist(), rel=1e-6)
    assert by_horizon(S.metric_pair(df), "rrse") == pytest.approx(rrse["forecast"].tolist(), rel=1e-6)


def test_lost_nodes_are_reported(case):
    _, _, _, _, df, nodes = case
    some = nodes.where("node_id <> 2")
    for score in (
        lambda: S.weighted_rmse(df, some),
        lambda: S.weighted_scores(df, some, nodes),
        lambda: S.weighted_acc(df, nodes, some),
    ):
        with pytest.raises(ValueError, match="1 nodes without"):
            score()
    kept = S.anomalies(df, some)
    assert kept.count() == df.count()
    assert kept.where("pred_anom IS NULL").count() == df.where("node_id = 2").count()


def test_anomalies_and_two_forecasts(case, spark):
    pred, true, _, clim, df, nodes = case
    got = S.anomalies(df, nodes).where("sample_id = 3 AND horizon = 2 AND node_id = 4").first()
    assert got["pred_anom"] == pytest.approx(pred[3, 1, 4] - clim[4])
    assert got["true_anom"] == pytest.approx(true[3, 1, 4] - clim[4])
    both = df.withColumn("other", F.col("pred") + 2.0)
    row = S.pair_disagreement(both, "pred", "other", beta=9.1).first()
    mse = [((pred + d - true) ** 2).mean() for d in (0, 2)]
    assert row["disagreement"] == pytest.approx(4.0)
    assert row["score"] == pytest.approx(sum(mse) / 2 + 9.1 * 4)


def test_alignment(case):
    *_, df, _ = case
    forecast = df.select("sample_id", "horizon", "node_id", "pred").where("sample_id < 30")
    truth = df.select("sample_id", "horizon", "node_id", "true").where("sample_id >= 10")
    assert S.align_forecast(forecast, truth).count() == 20 * 18
    row = S.alignment_report(forecast, truth).first()
    assert tuple(row) == (20 * 18, 10 * 18, 10 * 18)


def test_physical_units(case):
    pred, true, _, _, df, _ = case
    panel = df.select("node_id", F.col("true").alias("t2m"), F.col("pred").alias("other"))
    scaler = fit(panel, ["t2m", "other"], "std", "column")
    scaled = scaler.transform(df, {"pred": "t2m", "true": "t2m"}, suffix="")
    assert scaled.columns == df.columns
    row = S.mae_unscaled(scaled, scaler, "t2m", mask=305.0).first()
    assert row["mae"] == pytest.approx(np.abs(pred - true)[true > 305].mean())


# --- graph --------------------------------------------------------------------


@pytest.fixture(scope="module")
def graph(spark):
    rng = np.random.default_rng(8)
    n = 7  # node 6 is isolated
    pairs = [tuple(map(int, rng.integers(0, 6, 2))) for _ in range(25)] + [(2, 2), (0, 1), (0, 1)]
    dense = np.zeros((n, n))
    for i, j in pairs:
        dense[i, j] += 1
    a, b = rng.normal(0, 1, (2, n, 8))
    vectors = spark.createDataFrame(
        [(i, a[i].tolist(), b[i].tolist()) for i in range(n)],
        "node_id long, a array<double>, b array<double>",
    )
    edges = spark.createDataFrame(pairs, "src long, dst long")
    return dense, a, b, G.edge_adjacency(edges), vectors


def to_dense(df, n, names):
    out = np.zeros((n, n))
    for i, j, v in df.select(*names).collect():
        out[i, j] = v
    return out


@pytest.mark.parametrize("mode", ["diff", "adv", "AD", "pre", "k"])
def test_edge_weights_laplacian_and_diffusion(spark, graph, mode):
    dense, a, b, adjacency, vectors = graph
    s = {"diff": a @ a.T, "adv": a @ b.T - b @ a.T}.get(mode, a @ b.T)
    want = {"pre": dense, "k": 1.5 * dense}.get(mode)
    if want is None:
        want = np.maximum(np.tanh(0.2 * s), 0) * dense
    weights = G.edge_weights(adjacency, vectors, mode, alpha=0.2, coefficient=1.5)
    edge_cols = ["src", "dst", "weight"]
    np.testing.assert_allclose(to_dense(weights, 7, edge_cols), want, atol=1e-12)
    lap = G.laplacian(weights, vectors)
    want_lap = np.diag(want.sum(axis=1)) - want.T
    np.testing.assert_allclose(to_dense(lap, 7, ["row", "col", "value"]), want_lap, atol=1e-12)
    x = np.random.default_rng(9).normal(size=(4, 7, 2))
    flow = G.diffusion_term(cube(spark, x), lap, ["f0", "f1"])
    got = flow.orderBy("time_step", "node_id").select("f0", "f1").toPandas().to_numpy()
    np.testing.assert_allclose(
        got.reshape(x.shape), -np.einsum("ij,tjf->tif", want_lap, x), atol=1e-9
    )
    # What leaves one node arrives at another.
    np.testing.assert_allclose(got.reshape(x.shape).sum(axis=1), 0, atol=1e-9)


@pytest.mark.parametrize("bound", [1, 7, 1000])
def test_hub_join(spark, bound):
    """A node with a third of all edges, and edges that occur twice."""
    r = np.random.default_rng(6)
    edges = [(0 if i % 3 == 0 else int(r.integers(1, 30)), int(r.integers(0, 30)), float(i)) for i in range(300)]
    edges += edges[:5] + [(None, 3, 1.0), (99, 3, 1.0)]
    big = spark.createDataFrame(edges, "src long, dst long, weight double")
    lookup = spark.createDataFrame([(i, float(i * i)) for i in range(40)], "src long, value double")
    got = sorted(tuple(x) for x in hub_join(big, lookup, "src", bound).select("src", "dst", "weight", "value").collect())
    assert got == sorted((s, d, w, float(s * s)) for s, d, w in edges if s is not None and s < 40)
    hubs = {x["src"]: x["_blocks"] for x in hub_blocks(big, "src", bound).collect()}
    n = sum(s == 0 for s, _, _ in edges)
    assert hubs.get(0) == (-(-n // bound) if n > bound else None)
    assert sum(hubs.values()) <= len(edges) / bound + len(hubs)


def test_hubs_do_not_change_weights(spark, graph):
    _, _, _, adjacency, vectors = graph
    one = {tuple(x)[:2]: x["weight"] for x in G.edge_weights(adjacency, vectors, "pair").collect()}
    two = {tuple(x)[:2]: x["weight"] for x in G.edge_weights(adjacency, vectors, "pair", bound=1).collect()}
    assert one == pytest.approx(two)


def test_no_task_groups_many_entries(spark, monkeypatch):
    """However the shuffle is laid out; with a hub, a self-loop, repeated edges and NULL ends."""
    monkeypatch.setattr(skew, "GROUPED", 50)
    pairs = [(0, i) for i in range(500)] + [(i, 1) for i in range(1, 300)] + [(3, 3)] * 4 + [(None, 7), (None, 7)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    adjacency = materialize(G.edge_adjacency(edges))
    lap = G.laplacian(adjacency, spark.createDataFrame([(i,) for i in range(600)], "node_id long"))
    want = {(i, i): 0.0 for i in range(600)}
    for s, d in pairs:
        want[s, s] = want.get((s, s), 0.0) + 1.0
        want[d, s] = want.get((d, s), 0.0) - 1.0
    rows = [tuple(r) for r in lap.collect()]
    assert len(rows) == len(want) and {(i, j): v for i, j, v in rows} == want
    for table in (G.edge_adjacency(edges), lap):
        in_task = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert max(in_task) < 150


def test_lookups_must_be_unique(spark):
    cells = spark.createDataFrame([(0,), (1,)], "node_id int")
    for rows, told in (([(0, 1.0)], "1 nodes without w, e.g. 1"), ([(0, 1.0), (1, 2.0), (1, 2.0)], "1 nodes with several rows for w, e.g. 1"), ([(0, 1.0), (1, None)], "without w")):
        with pytest.raises(ValueError, match=told):
            S.require_nodes(cells, [(spark.createDataFrame(rows, "node_id int, w double"), "w")])
    S.require_nodes(cells, [(spark.createDataFrame([(0, 1.0), (1, 2.0), (5, None), (5, None)], "node_id int, w double"), "w")])


def test_scratch_blocks_delete_their_own_tables(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch(spark):
        inner = materialize(spark.range(4), "inner")
        with scratch(spark):
            assert materialize(spark.range(5), "most").count() == 5
        assert inner.count() == 4
    assert kept.count() == 3
    with pytest.raises(Exception, match="FILE|exist"):
        inner.count()
    with scratch(spark) as keep:
        other, result = materialize(spark.range(2), "other"), keep(materialize(spark.range(6), "result"))
    assert result.count() == 6
    with pytest.raises(Exception, match="FILE|exist"):
        other.count()
    discard(kept)
    discard(result)
