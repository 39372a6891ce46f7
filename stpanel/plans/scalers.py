"""Normalizers: transform, inverse, and table encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stpanel.operators import moments
from stpanel.operators.scaling import fit, one_hot, one_hot_long
from stpanel.operators.storage import scratch_path
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded

COLS = ["f0", "f1", "f2"]


def _scaled(spark, sf, kind, scope, cols=COLS):
    """The scaled features only, one column each."""
    panel = fx.panel(spark, sf).select("time_step", "node_id", *cols)
    scaler = fit(panel, cols, kind, scope)
    return rounded(scaler.transform(panel, suffix=""), cols)


def _sql(formula: str, aggs: str, over: str = "", cols=COLS) -> str:
    """``formula`` on each column, with window aggregates in place of {a}, {b}."""
    parts = []
    for c in cols:
        a, b = (s.format(c=c) + f" OVER ({over})" for s in aggs.split(";"))
        parts.append(f"{r(formula.format(c=c, a=a, b=b))} AS {c}")
    return f"SELECT time_step, node_id, {', '.join(parts)} FROM panel"


STD = "({c} - {a}) / {b}"
STD_AGGS = "avg({c});stddev_pop({c})"
RANGE = "({c} - {a}) / ({b} - {a})"
RANGE_AGGS = "min({c});max({c})"
PER_NODE = "PARTITION BY node_id"

POOLED = """, pooled AS (
  SELECT avg(v) AS mu, stddev_pop(v) AS sd, min(v) AS lo, max(v) AS hi
  FROM (SELECT unnest([f0, f1, f2]) AS v FROM panel))
"""


def _pooled_sql(formula: str) -> str:
    parts = [f"{r(formula.format(c=c))} AS {c}" for c in COLS]
    return f"{POOLED} SELECT time_step, node_id, {', '.join(parts)} FROM panel, pooled"


@query("norm_none", "SELECT time_step, node_id, f0, f1, f2 FROM panel")
def norm_none(spark, sf):
    return _scaled(spark, sf, "none", "global")


@query("norm_std_global", _pooled_sql("({c} - mu) / sd"))
def norm_std_global(spark, sf):
    return _scaled(spark, sf, "std", "global")


@query("norm_std_feature", _sql(STD, STD_AGGS))
def norm_std_feature(spark, sf):
    return _scaled(spark, sf, "std", "feature")


@query("norm_std_column", _sql(STD, STD_AGGS, PER_NODE))
def norm_std_column(spark, sf):
    return _scaled(spark, sf, "std", "column")


@query("norm_max01", _sql(RANGE, RANGE_AGGS, PER_NODE))
def norm_max01(spark, sf):
    return _scaled(spark, sf, "max01", "column")


@query("norm_max01_global", _pooled_sql("({c} - lo) / (hi - lo)"))
def norm_max01_global(spark, sf):
    return _scaled(spark, sf, "max01", "global")


@query("norm_max11", _sql(f"2 * ({RANGE}) - 1", RANGE_AGGS, PER_NODE))
def norm_max11(spark, sf):
    return _scaled(spark, sf, "max11", "column")


@query("norm_max11_global", _pooled_sql("2 * (({c} - lo) / (hi - lo)) - 1"))
def norm_max11_global(spark, sf):
    return _scaled(spark, sf, "max11", "global")


@query(
    "norm_cmax",
    f"""SELECT time_step, node_id,
           {r("(f0 - min(f0) OVER w) / (max(f0) OVER w - min(f0) OVER w)")} AS f0,
           0.0::DOUBLE AS flat
    FROM panel WINDOW w AS (PARTITION BY node_id)""",
)
def norm_cmax(spark, sf):
    """With a constant column, whose zero range counts as 1."""
    panel = fx.panel(spark, sf).select("time_step", "node_id", "f0", F.lit(1.0).alias("flat"))
    scaler = fit(panel, ["f0", "flat"], "cmax")
    return rounded(scaler.transform(panel, suffix=""), ["f0", "flat"])


@query(
    "minmax_columns",
    f"""SELECT l_orderkey, l_linenumber,
           {r("(l_quantity - q0) / (q1 - q0)")} AS l_quantity,
           {r("(l_extendedprice - p0) / (p1 - p0)")} AS l_extendedprice,
           {r("(l_discount - d0) / (d1 - d0)")} AS l_discount
    FROM lineitem, (
      SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS p0,
             max(l_extendedprice) AS p1, min(l_discount) AS d0, max(l_discount) AS d1
      FROM lineitem)""",
)
def minmax_columns(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    return rounded(fit(rows, cols, "max01", "feature").transform(rows, suffix=""), cols)


@query(
    "one_hot",
    """, codes AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
                        CAST(month(o_orderdate) AS INTEGER) AS month FROM orders),
    ends AS (SELECT min(level) AS a, max(level) AS b, min(month) AS c, max(month) AS d FROM codes)
    SELECT o_orderkey,
           array_to_string([CAST(v = level AS INTEGER) FOR v IN range(a, b + 1)], '') AS level,
           array_to_string([CAST(v = month AS INTEGER) FOR v IN range(c, d + 1)], '') AS month
    FROM codes, ends""",
)
def one_hot_columns(spark, sf):
    """Indicator arrays, joined to text so that both engines print them alike."""
    made = one_hot(_order_codes(spark, sf), ["level", "month"])
    return made.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), "") for c in ("level", "month")}
    )


@query(
    "one_hot_long",
    """, codes AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
                        CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
    SELECT o_orderkey, 'level' AS "column",
           CAST(level - (SELECT min(level) FROM codes) AS BIGINT) AS position FROM codes
    UNION ALL
    SELECT o_orderkey, 'month',
           CAST(month - (SELECT min(month) FROM codes)
                + (SELECT max(level) - min(level) + 1 FROM codes) AS BIGINT) FROM codes""",
)
def one_hot_positions(spark, sf):
    return one_hot_long(_order_codes(spark, sf), ["o_orderkey"], ["level", "month"])


def _order_codes(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        F.month("o_orderdate").cast("int").alias("month"),
    )


@query(
    "inverse_roundtrip",
    f"SELECT time_step, node_id, {', '.join(f'{r(c)} AS {c}' for c in COLS)} FROM panel",
)
def inverse_roundtrip(spark, sf):
    """Each feature is scaled and restored by a normalizer of another kind."""
    panel = fx.panel(spark, sf).select("time_step", "node_id", *COLS)
    kinds = [("f0", "std", "feature"), ("f1", "max11", "column"), ("f2", "max01", "global")]
    for c, kind, scope in kinds:
        scaler = fit(panel.select("node_id", c), [c], kind, scope)
        panel = scaler.inverse(scaler.transform(panel, suffix=""), {c: c})
    return rounded(panel, COLS)


FAR = 1_000_000  # an offset that costs squares of raw values their digits
FAR_SQL = ", ".join(f"{c} + {FAR} AS {c}" for c in COLS)


def _far(spark, sf):
    """The panel with all features a million higher."""
    rows = fx.panel(spark, sf).select("time_step", "node_id", *COLS)
    return rows.withColumns({c: F.col(c) + F.lit(float(FAR)) for c in COLS})


@query(
    "merged_fit",
    f", far AS (SELECT time_step, node_id, {FAR_SQL} FROM panel) "
    + _sql(STD, STD_AGGS, PER_NODE).replace("FROM panel", "FROM far"),
)
def merged_fit(spark, sf):
    """Both time halves are fitted alone; their merged moments scale all rows."""
    rows = _far(spark, sf)
    cut = fx.n_steps(rows) // 2
    halves = [moments.moments(rows.where(half), COLS, ["node_id"]) for half in (F.col("time_step") < cut, F.col("time_step") >= cut)]
    scaler = moments.scaler(halves[0].unionByName(halves[1]), COLS, "std", "column")
    return rounded(scaler.transform(rows, suffix=""), COLS)


@query(
    "appended_fit",
    f""", far AS (SELECT node_id, unnest(['f0', 'f1', 'f2']) AS feature,
                         unnest([{", ".join(f"{c} + {FAR}.0" for c in COLS)}])::DOUBLE AS v FROM panel)
    SELECT node_id, feature, count(*) AS n, {r("avg(v)")} AS mean, {r("stddev_pop(v)")} AS deviation,
           min(v) AS low, max(v) AS high FROM far GROUP BY node_id, feature""",
)
def appended_fit(spark, sf):
    """Moments appended week by week, one week twice, read as if fitted at once."""
    rows, path = _far(spark, sf), scratch_path(spark, "moments")
    last = fx.n_steps(rows) // 7
    for week in [*range(8), 3]:
        batch = F.least(F.call_function("div", F.col("time_step"), F.lit(max(last, 1))), F.lit(7)) == week
        moments.append_moments(rows.where(batch), COLS, path, f"week {week}")
    found = moments.read_moments(spark, path).withColumn("deviation", F.sqrt(F.col("m2") / F.col("n"))).drop("m2")
    return rounded(found, ["mean", "deviation"])
