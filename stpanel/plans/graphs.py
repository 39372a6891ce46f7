"""Edge tables and diffusion."""

from __future__ import annotations

from stpanel.operators import graph as G
from stpanel.operators.storage import materialize
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded


@query("edge_adjacency", "SELECT src, dst, weight FROM adjacency")
def edge_adjacency(spark, sf):
    return G.edge_adjacency(fx.order_edges(spark, sf))


DOT = "list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def _weights_sql(s: str) -> str:
    return f"""SELECT src, dst, {r(f"greatest(0.0, tanh(0.2 * ({s}))) * weight")} AS weight
    FROM adjacency JOIN vectors i ON i.node_id = src JOIN vectors j ON j.node_id = dst"""


def _weights(spark, sf, mode):
    adjacency = G.edge_adjacency(fx.order_edges(spark, sf))
    return rounded(G.edge_weights(adjacency, fx.node_vectors(spark, sf), mode), ["weight"])


@query("edge_weights", _weights_sql(DOT.format(a="i.a", b="j.b")))
def edge_weights(spark, sf):
    return _weights(spark, sf, "pair")


@query("edge_weights_diff", _weights_sql(DOT.format(a="i.a", b="j.a")))
def edge_weights_diff(spark, sf):
    return _weights(spark, sf, "diff")


@query(
    "edge_weights_adv",
    _weights_sql(DOT.format(a="i.a", b="j.b") + " - " + DOT.format(a="i.b", b="j.a")),
)
def edge_weights_adv(spark, sf):
    return _weights(spark, sf, "adv")


@query("edge_weights_scaled", f"SELECT src, dst, {r('weight * 0.5')} AS weight FROM adjacency")
def edge_weights_scaled(spark, sf):
    adjacency = G.edge_weights(G.edge_adjacency(fx.order_edges(spark, sf)), mode="pre")
    return G.edge_weights(adjacency, mode="k", coefficient=0.5)


@query(
    "laplacian",
    f"""SELECT "row", col, {r("sum(value)")} AS value
    FROM (SELECT src AS "row", src AS col, sum(weight) AS value FROM adjacency GROUP BY src
          UNION ALL SELECT dst, src, -weight FROM adjacency
          UNION ALL SELECT node_id, node_id, 0.0 FROM vectors)
    GROUP BY "row", col""",
)
def laplacian(spark, sf):
    nodes = fx.node_vectors(spark, sf).select("node_id")
    weights = materialize(G.edge_adjacency(fx.order_edges(spark, sf)), "adjacency")
    return rounded(G.laplacian(weights, nodes), ["value"])


@query(
    "diffusion_term",
    f""", flow AS (
      SELECT p.time_step, e.dst AS node_id, p.f0, p.f1
      FROM grid_edges e JOIN panel p ON p.node_id = e.src),
    inflow AS (SELECT time_step, node_id, sum(f0) AS f0, sum(f1) AS f1 FROM flow GROUP BY 1, 2),
    deg AS (SELECT src AS node_id, count(*) AS d FROM grid_edges GROUP BY src)
    SELECT p.time_step, CAST(p.node_id AS BIGINT) AS node_id,
           {r("i.f0 - d * p.f0")} AS f0, {r("i.f1 - d * p.f1")} AS f1
    FROM panel p JOIN inflow i USING (time_step, node_id) JOIN deg USING (node_id)""",
)
def diffusion_term(spark, sf):
    weights = materialize(G.edge_adjacency(fx.grid_edges(spark, sf)), "adjacency")
    lap = materialize(G.laplacian(weights, fx.node_dim(spark, sf)), "laplacian")
    return rounded(G.diffusion_term(fx.panel(spark, sf), lap, ["f0", "f1"]), ["f0", "f1"])
