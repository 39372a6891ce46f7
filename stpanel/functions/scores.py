"""Forecast scores as aggregate expressions.

Each function returns an aggregate ``Column``, so any mix of scores, masks and
groupings is one hash aggregate with map-side partial sums::

    predictions.groupBy("horizon").agg(mae().alias("mae"), mape(mask=0.0).alias("mape"))

``mask=m`` keeps the rows with ``true > m`` (strictly); ``mask=None`` keeps all.
A group in which no row is kept scores NULL ("not available").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stpanel.functions.scalar import as_col, ieee_div

PRED = "pred"
TRUE = "true"


def kept(value: Column, true: Column, mask: float | None) -> Column:
    """``value`` on the rows the mask keeps, NULL elsewhere (aggregates skip it)."""
    if mask is None:
        return value
    # NaN compares above every number in Spark, but a NaN truth is never kept.
    return F.when((true > F.lit(float(mask))) & ~F.isnan(true), value)


def _pair(pred: Column | str, true: Column | str) -> tuple[Column, Column]:
    return as_col(pred), as_col(true)


def mae(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    p, y = _pair(pred, true)
    return F.avg(kept(F.abs(p - y), y, mask))


def mse(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    p, y = _pair(pred, true)
    return F.avg(kept((p - y) * (p - y), y, mask))


def rmse(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    return F.sqrt(mse(pred, true, mask))


def rrse(pred=PRED, true=TRUE, mask: float | None = None, variant: str = "truth") -> Column:
    """Root relative squared error.

    The denominator measures the spread around the mean truth of the truth
    (``variant="truth"``, the textbook form) or of the forecast
    (``variant="forecast"``). Both come from central moments, which Spark merges
    stably, so one pass is enough and no large squares cancel.
    """
    p, y = _pair(pred, true)
    err = F.sum(kept((p - y) * (p - y), y, mask))
    py, yy = kept(p, y, mask), kept(y, y, mask)
    if variant == "truth":
        spread = F.var_pop(yy)
    elif variant == "forecast":
        shift = F.avg(py) - F.avg(yy)
        spread = F.var_pop(py) + shift * shift
    else:
        raise ValueError(f"unknown RRSE variant: {variant!r}")
    return ieee_div(F.sqrt(err), F.sqrt(spread * F.count(yy)))


def mape(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    p, y = _pair(pred, true)
    return F.avg(kept(F.abs(ieee_div(y - p, y)), y, mask))


def pnbi(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    """Share of over-forecasts."""
    p, y = _pair(pred, true)
    return F.avg(kept(F.when(p - y > 0, 1.0).otherwise(0.0), y, mask))


def opnbi(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    """Mean of ``(true + pred) / (2 true)``; above 1 means over-forecasting."""
    p, y = _pair(pred, true)
    return F.avg(kept(ieee_div(y + p, y * 2.0), y, mask))


def mare(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    p, y = _pair(pred, true)
    return ieee_div(F.sum(kept(F.abs(y - p), y, mask)), F.sum(kept(y, y, mask)))


def smape(pred=PRED, true=TRUE, mask: float | None = None) -> Column:
    p, y = _pair(pred, true)
    return F.avg(kept(ieee_div(F.abs(y - p), F.abs(y) + F.abs(p)), y, mask))
