"""Splits, time features, windows and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from stpanel.operators import splits as S
from stpanel.operators import windows as W
from stpanel.operators.panel import time_join
from stpanel.operators.shuffling import PRIME, ROUNDS, round_keys, shuffle_positions
from stpanel.operators.storage import materialize
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded


@query("split_calendar", "SELECT time_step, coord, split FROM split_dim")
def split_calendar(spark, sf):
    return fx.split_dim(spark, sf)


def _tail_sql(tail: str, test: str) -> str:
    return f"""SELECT time_step, CASE WHEN i < n - {tail} THEN 'train'
                                   WHEN i < n - {test} THEN 'val' ELSE 'test' END AS split
    FROM (SELECT time_step, row_number() OVER (ORDER BY time_step) - 1 AS i,
                 count(*) OVER () AS n FROM time_dim)"""


@query("split_days", _tail_sql("2 * 12", "1 * 12"))
def split_days(spark, sf):
    """Two-hour steps: 12 of them make a day."""
    return S.split_days(fx.time_dim(spark, sf).select("time_step"), 1, 1, interval=120)


@query("split_ratio", _tail_sql("CAST(floor(n * 0.35) AS BIGINT)", "CAST(floor(n * 0.15) AS BIGINT)"))
def split_ratio(spark, sf):
    return S.split_ratio(fx.time_dim(spark, sf).select("time_step"), 0.2, 0.15)


@query("split_numbers", _tail_sql("18", "7"))
def split_numbers(spark, sf):
    return S.split_numbers(fx.time_dim(spark, sf).select("time_step"), 11, 7)


@query(
    "split_sizes",
    """SELECT s.split, count(d.time_step) AS n_steps,
           CAST(greatest(count(d.time_step) - 10, 0) AS BIGINT) AS n_windows
    FROM (SELECT unnest(['train', 'val', 'test']) AS split) s LEFT JOIN split_dim d USING (split)
    GROUP BY s.split""",
)
def split_sizes(spark, sf):
    return S.split_sizes(fx.split_dim(spark, sf), fx.LAG, fx.HORIZON)


@query(
    "tod_feature",
    f"""SELECT time_step, node_id, f0, {r("(hour(coord) // 6) / 3.0")} AS tod
    FROM panel JOIN time_dim USING (time_step)""",
)
def tod_feature(spark, sf):
    dim = materialize(S.tod_feature(fx.time_dim(spark, sf)).drop("coord"), "tod")
    rows = time_join(fx.panel(spark, sf).select("time_step", "node_id", "f0"), dim)
    return rounded(rows, ["tod"])


def _samples(spark, sf, inputs=("f0",), targets=("f0",), **options):
    panel = W.split_panel(fx.panel(spark, sf), fx.split_dim(spark, sf))
    return W.sliding_windows(panel, fx.LAG, fx.HORIZON, list(inputs), list(targets), **options)


def _sql_samples(cols: str, last: int = 10) -> str:
    return f"""SELECT split, node_id, pos AS sample_id, {cols}
    FROM split_panel
    WINDOW w AS (PARTITION BY split, node_id ORDER BY pos)
    QUALIFY lead(pos, {last}) OVER w = pos + {last}"""


def _lead(col: str, k: int, name: str) -> str:
    return f"{col} AS {name}" if k == 0 else f"lead({col}, {k}) OVER w AS {name}"


@query(
    "window_multi",
    _sql_samples(
        ", ".join(
            [_lead("f0", k, f"x{k}") for k in range(7)]
            + [_lead("f0", 6 + h, f"y{h}") for h in range(1, 5)]
        )
    ),
)
def window_multi(spark, sf):
    return _samples(spark, sf).select(
        "split",
        "node_id",
        "sample_id",
        *[F.col("x")[k]["f0"].alias(f"x{k}") for k in range(fx.LAG)],
        *[F.col("y")[h]["f0"].alias(f"y{h + 1}") for h in range(fx.HORIZON)],
    )


@query(
    "window_multi_long",
    """SELECT a.split, a.node_id, a.pos AS sample_id, CAST(b.pos - a.pos AS INTEGER) AS step,
           b.f0, b.f1
    FROM split_panel a JOIN split_panel b
      ON b.split = a.split AND b.node_id = a.node_id AND b.pos BETWEEN a.pos AND a.pos + 10
    WHERE a.pos + 10 <= (SELECT max(c.pos) FROM split_panel c WHERE c.split = a.split)""",
)
def window_multi_long(spark, sf):
    """Long form: steps 0 .. lag-1 are inputs, the others targets."""
    cols = ["f0", "f1"]
    windows = _samples(spark, sf, cols, cols)
    steps = F.posexplode(F.concat("x", "y")).alias("step", "_s")
    return windows.select("split", "node_id", "sample_id", steps).select(
        "split", "node_id", "sample_id", "step", "_s.*"
    )


@query("window_single", _sql_samples(", ".join([_lead("f0", 6, "x_last"), _lead("f0", 10, "y")])))
def window_single(spark, sf):
    return _samples(spark, sf, single=True).select(
        "split",
        "node_id",
        "sample_id",
        F.col("x")[fx.LAG - 1]["f0"].alias("x_last"),
        F.col("y")[0]["f0"].alias("y"),
    )


@query(
    "exog_target_slice",
    _sql_samples(
        ", ".join(
            [_lead(c, k, f"{c}_{k}") for k in (0, 6) for c in ("f1", "f2")]
            + [_lead("f0", 6 + h, f"y{h}") for h in range(1, 5)]
        )
    ),
)
def exog_target_slice(spark, sf):
    panel = W.split_panel(fx.panel(spark, sf), fx.split_dim(spark, sf))
    windows = W.exog_target_windows(panel, fx.LAG, fx.HORIZON, ["f0", "f1", "f2"])
    return windows.select(
        "split",
        "node_id",
        "sample_id",
        *[F.col("x")[k][c].alias(f"{c}_{k}") for k in (0, 6) for c in ("f1", "f2")],
        *[F.col("y")[h]["f0"].alias(f"y{h + 1}") for h in range(fx.HORIZON)],
    )


@query(
    "lag_vector",
    _sql_samples(
        ", ".join(
            _lead(c, k, f"v{2 * k + j}") for k in range(7) for j, c in enumerate(("f0", "f1"))
        )
    ),
)
def lag_vector(spark, sf):
    rows = W.lag_vector(_samples(spark, sf, ["f0", "f1"]), ["f0", "f1"])
    return rows.select(
        "split",
        "node_id",
        "sample_id",
        *[F.col("lag_vector")[i].alias(f"v{i}") for i in range(2 * fx.LAG)],
    )


SAMPLES_SQL = """, samples AS (
  SELECT split, pos AS sample_id FROM (SELECT DISTINCT split, pos FROM split_panel) p
  WHERE pos + 10 <= (SELECT max(c.pos) FROM split_panel c WHERE c.split = p.split))
"""


def _sample_ids(spark, sf):
    """Sample ids from the split sizes: no window has to be built to list them."""
    return W.sample_ids(fx.split_dim(spark, sf), fx.LAG, fx.HORIZON)


@query(
    "batch_assign",
    SAMPLES_SQL
    + """SELECT split, sample_id, sample_id // 16 AS batch_id FROM samples s
    WHERE sample_id // 16 < (SELECT count(*) // 16 FROM samples t WHERE t.split = s.split)""",
)
def batch_assign(spark, sf):
    return W.assign_batches(_sample_ids(spark, sf), 16, drop_last=True)


def _shuffle_sql(seed: int) -> str:
    """The rounds of the bijection one by one, and the walk back into the ids, as a recursion."""
    keys = ", ".join(f"({i}, {k}, {v})" for i, (k, v) in enumerate(round_keys(seed)))
    return f""", sizes AS (
      SELECT split, count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM samples GROUP BY split),
    grids AS (SELECT split, n, a, (n + a - 1) // a AS b FROM sizes),
    keys AS (SELECT * FROM (VALUES {keys}) AS k(round, k, l)),
    walk AS (
      SELECT split, sample_id, n, 0 AS round, sample_id // b AS x, sample_id % b AS y, a AS m, b AS w
      FROM samples JOIN grids USING (split)
      UNION ALL
      SELECT split, sample_id, n, CASE WHEN w.round + 1 = {ROUNDS} AND pos >= n THEN 0 ELSE w.round + 1 END,
             CASE WHEN w.round + 1 = {ROUNDS} AND pos >= n THEN pos // m ELSE y END,
             CASE WHEN w.round + 1 = {ROUNDS} AND pos >= n THEN pos % m ELSE z END, w, m
      FROM (SELECT w.*, (x + (((y + k) * (y + k)) % {PRIME} + l) * (((y + k) * (y + k)) % {PRIME} + l) % {PRIME}) % m AS z,
                   y * m + z AS pos
            FROM walk w JOIN keys USING (round)) w)
    SELECT split, sample_id, x * w + y AS shuffled, (x * w + y) // 16 AS batch_id FROM walk WHERE round = {ROUNDS}"""


@query("batch_shuffle", SAMPLES_SQL + _shuffle_sql(7))
def batch_shuffle(spark, sf):
    samples = _sample_ids(spark, sf)
    sizes = S.split_sizes(fx.split_dim(spark, sf), fx.LAG, fx.HORIZON).collect()  # one row per split
    shuffled = shuffle_positions(samples, {r["split"]: r["n_windows"] for r in sizes}, seed=7)
    return W.assign_batches(shuffled, 16, order="shuffled")


@query(
    "batches_per_epoch",
    SAMPLES_SQL
    + """SELECT split, CAST(count(DISTINCT sample_id // 16) AS BIGINT) AS n_batches
    FROM samples GROUP BY split""",
)
def batches_per_epoch(spark, sf):
    return W.batches_per_epoch(W.assign_batches(_sample_ids(spark, sf), 16))
