"""Column expressions: IEEE helpers and forecast scores."""

from stpanel.functions.scalar import dot, finite, ieee_div, is_missing, relu
from stpanel.functions.scores import (
    mae,
    mape,
    mare,
    mse,
    opnbi,
    pnbi,
    rmse,
    rrse,
    smape,
)

__all__ = [
    "dot",
    "finite",
    "ieee_div",
    "is_missing",
    "mae",
    "mape",
    "mare",
    "mse",
    "opnbi",
    "pnbi",
    "relu",
    "rmse",
    "rrse",
    "smape",
]
