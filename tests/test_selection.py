"""Run selection against a plain replay of the epochs."""

import math
import random

import pytest

from stpanel.operators import selection as S

NAN, INF = float("nan"), float("inf")
SCHEMA = "run_id string, epoch int, train_loss double, val_loss double, rmse_w double, acc_w double"


def made_runs(seed):
    rng = random.Random(seed)

    def value():
        return rng.choice([NAN, INF, None, *[float(rng.randint(1, 9)) for _ in range(12)]])

    rows = []
    for i in range(25):
        for epoch in range(1, rng.randint(1, 40) + 1):
            train = 2e6 if rng.random() < 0.02 else rng.choice([NAN, 1e6, float(rng.randint(1, 9))])
            val = None if i % 5 == 0 else rng.choice([NAN, INF, *range(1, 12)])
            rows.append(
                (f"r{i}", epoch, train, None if val is None else float(val), value(), value())
            )
    return rows


def of_run(rows):
    runs = {}
    for row in rows:
        runs.setdefault(row[0], []).append(row)
    return runs


def usable(v):
    return v is not None and not math.isnan(v) and v != INF


def two_best(values):
    """Smallest two distinct values with their first epochs, after every epoch."""
    seen, trace = {}, []
    for epoch, v in values:
        if usable(v):
            seen.setdefault(v, epoch)
        best = sorted(seen.items())[:2] + [(None, None)] * 2
        trace.append((*best[0], *best[1]))
    return trace


def ends(rows, patience):
    """(stop epoch, reason, kept epoch, kept loss) of one run."""
    best, kept, waited = INF, None, 0
    for _, epoch, train, val, *_ in rows:
        loss = train if val is None else val
        if train > 1e6:
            return epoch, "diverged", kept or epoch, best if kept else None
        if loss < best:
            best, kept, waited = loss, epoch, 0
        else:
            waited += 1
            if waited == patience:
                return epoch, "patience", kept or epoch, best if kept else None
    return None, "completed", kept or rows[-1][1], best if kept else None


@pytest.fixture(scope="module", params=[1, 2])
def runs(request, spark):
    rows = made_runs(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("patience", [1, 3, 7])
def test_stop_and_checkpoint(runs, patience):
    rows, df = runs
    want = {run: ends(part, patience) for run, part in of_run(rows).items()}
    stops = {r["run_id"]: (r["stop_epoch"], r["reason"]) for r in S.early_stop(df, patience).collect()}
    assert stops == {run: w[:2] for run, w in want.items()}
    best = {r[0]: (r[1], r[2]) for r in S.best_checkpoint(df, patience).collect()}
    assert best == {run: w[2:] for run, w in want.items()}


def test_trace_and_two_best(runs):
    rows, df = runs
    trace = S.best_so_far(df, {"rmse_w": "min", "acc_w": "max"})
    got = {(r["run_id"], r["epoch"]): r for r in trace.collect()}
    two = {(r["run_id"], r["place"]): (r["value"], r["epoch"])
           for r in S.best_two_epochs(df, "rmse_w").collect()}
    for run, part in of_run(rows).items():
        low = two_best([(r[1], r[4]) for r in part])
        # The highest value is the lowest negated one; +inf counts here.
        high = two_best([(r[1], None if r[5] is None else -r[5]) for r in part])
        for row, lo, hi in zip(part, low, high):
            g = got[run, row[1]]
            assert (
                g["rmse_w_best"], g["rmse_w_best_epoch"], g["rmse_w_second"],
                g["rmse_w_second_epoch"],
            ) == lo
            assert g["acc_w_best"] == (None if hi[0] is None else -hi[0])
            assert (g["acc_w_best_epoch"], g["acc_w_second_epoch"]) == (hi[1], hi[3])
        last = low[-1]
        assert two.get((run, 1), (None, None)) == last[:2]
        assert two.get((run, 2), (None, None)) == last[2:]


def test_best_trial(spark, runs):
    rows, df = runs
    want = min(
        (min(r[4] for r in part if usable(r[4])), run)
        for run, part in of_run(rows).items()
        if any(usable(r[4]) for r in part)
    )
    row = S.best_trial(df).first()
    assert (row["best_value"], row["run_id"]) == want


def test_epoch_loss(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 5.0)], "run_id string, epoch int, loss double"
    )
    got = {(r["run_id"], r["epoch"]): r["train_loss"] for r in S.epoch_loss(df).collect()}
    assert got == {("a", 1): 3.0, ("a", 2): 5.0}
