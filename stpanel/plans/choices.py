"""Epoch and run selection on the runs derived from orders."""

from __future__ import annotations

from stpanel.operators import selection as S
from stpanel.plans import fixtures as fx
from stpanel.plans.registry import query, r, rounded

PATIENCE = 6

LOSS_SQL = """, losses AS (
  SELECT run_id, epoch, train_loss > 1e6 AS diverged,
         CASE WHEN isnan(coalesce(val_loss, train_loss)) THEN NULL
              ELSE coalesce(val_loss, train_loss) END AS loss FROM runs),
gains AS (
  SELECT *, loss IS NOT NULL AND coalesce(loss < min(loss) OVER (
           PARTITION BY run_id ORDER BY epoch
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved FROM losses),
stalls AS (
  SELECT *, epoch - coalesce(max(CASE WHEN improved THEN epoch END) OVER (
           PARTITION BY run_id ORDER BY epoch), 0) AS behind FROM gains),
ends AS (
  SELECT run_id, min(CASE WHEN diverged THEN epoch END) AS d,
         min(CASE WHEN behind = 6 THEN epoch END) AS p FROM stalls GROUP BY run_id),
stops AS (
  SELECT run_id, least(d, p) AS stop_epoch,
         CASE WHEN d IS NOT NULL AND (p IS NULL OR d <= p) THEN 'diverged'
              WHEN p IS NOT NULL THEN 'patience' ELSE 'completed' END AS reason FROM ends)
"""


def _two_sql(metric: str, way: str) -> str:
    return f"""SELECT '{metric}' AS metric, run_id, place, value, epoch FROM (
      SELECT run_id, {metric} AS value, min(epoch) AS epoch,
             CAST(row_number() OVER (PARTITION BY run_id ORDER BY {metric} {way}) AS INTEGER)
               AS place
      FROM runs WHERE {metric} IS NOT NULL GROUP BY run_id, {metric}) WHERE place <= 2"""


@query("best_two_epochs", _two_sql("rmse_w", "ASC") + " UNION ALL " + _two_sql("acc_w", "DESC"))
def best_two_epochs(spark, sf):
    runs = fx.runs(spark, sf)
    parts = [
        S.best_two_epochs(runs, metric, best).selectExpr(f"'{metric}' AS metric", "*")
        for metric, best in (("rmse_w", "min"), ("acc_w", "max"))
    ]
    return parts[0].unionByName(parts[1])


def _trace_sql(metric: str, way: str) -> str:
    return f"""(SELECT run_id, epoch,
      max(value) FILTER (place = 1) AS {metric}_best,
      CAST(max(seen) FILTER (place = 1 AND value IS NOT NULL) AS INTEGER) AS {metric}_best_epoch,
      max(value) FILTER (place = 2) AS {metric}_second,
      CAST(max(seen) FILTER (place = 2 AND value IS NOT NULL) AS INTEGER) AS {metric}_second_epoch
    FROM (
      SELECT run_id, epoch, value, seen,
             row_number() OVER (PARTITION BY run_id, epoch ORDER BY value {way} NULLS LAST) AS place
      FROM (SELECT a.run_id, a.epoch, b.{metric} AS value, min(b.epoch) AS seen
            FROM runs a JOIN runs b ON b.run_id = a.run_id AND b.epoch <= a.epoch
            GROUP BY a.run_id, a.epoch, b.{metric}))
    GROUP BY run_id, epoch)"""


@query(
    "best_so_far",
    f"""SELECT * FROM {_trace_sql("rmse_w", "ASC")}
    JOIN {_trace_sql("acc_w", "DESC")} USING (run_id, epoch)""",
)
def best_so_far(spark, sf):
    return S.best_so_far(fx.runs(spark, sf), {"rmse_w": "min", "acc_w": "max"})


@query("early_stop", LOSS_SQL + "SELECT run_id, stop_epoch, reason FROM stops")
def early_stop(spark, sf):
    return S.early_stop(fx.runs(spark, sf), PATIENCE)


@query(
    "best_checkpoint",
    LOSS_SQL
    + f"""SELECT run_id, CAST(coalesce(arg_min(epoch, loss) FILTER (ok), max(epoch) FILTER (ran))
                        AS INTEGER) AS best_epoch, {r("min(loss) FILTER (ok)")} AS best_loss
    FROM (SELECT l.*, stop_epoch IS NULL OR epoch <= stop_epoch AS ran,
                 loss IS NOT NULL AND (stop_epoch IS NULL OR epoch < stop_epoch) AS ok
          FROM losses l JOIN stops USING (run_id))
    GROUP BY run_id""",
)
def best_checkpoint(spark, sf):
    return rounded(S.best_checkpoint(fx.runs(spark, sf), PATIENCE), ["best_loss"])


@query(
    "best_trial",
    """SELECT run_id, min(rmse_w) AS best_value FROM runs GROUP BY run_id
    ORDER BY best_value, run_id LIMIT 1""",
)
def best_trial(spark, sf):
    return S.best_trial(fx.runs(spark, sf))


@query(
    "epoch_loss",
    f"SELECT run_id, epoch, {r('avg(loss)')} AS train_loss FROM batches GROUP BY run_id, epoch",
)
def epoch_loss(spark, sf):
    return rounded(S.epoch_loss(fx.order_batches(spark, sf)), ["train_loss"])
