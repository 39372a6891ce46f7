"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(a: Column, b: Column) -> Column:
    """``a / b`` with array-library results for ``b = 0``: +-inf, or NaN for 0/0.

    Spark raises (ANSI) or returns NULL here, depending on the session. The
    guard keeps the result the same under both settings.
    """
    a = a.cast("double")
    b = b.cast("double")
    at_zero = (
        F.when(a.isNull(), F.lit(None).cast("double"))
        .when((a == 0) | F.isnan(a), F.lit(NAN))
        .otherwise(F.signum(a) * F.lit(INF))
    )
    return F.when(b == 0, at_zero).otherwise(a / F.when(b != 0, b))


def is_missing(c: Column | str) -> Column:
    """True for NULL and for NaN; Spark treats the two as different values."""
    c = as_col(c)
    return c.isNull() | F.coalesce(F.isnan(c), F.lit(False))


def finite(c: Column | str) -> Column:
    """The value itself, or NULL where it is NULL, NaN or infinite."""
    c = as_col(c)
    return F.when(~is_missing(c) & (F.abs(c) < INF), c)


def relu(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two equally long numeric arrays, in double precision."""
    products = F.zip_with(
        as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
