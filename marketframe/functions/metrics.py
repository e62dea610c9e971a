"""Forecast metrics as aggregate Column builders.

Each builder takes an *actual* and a *predicted* column and returns an aggregate
Column, so a metric table for any grouping is one ``groupBy(...).agg(...)`` with
partial (map-side) aggregation. Rows with a NULL on either side must be filtered
before aggregating (``evaluate`` does this).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
TRADING_DAYS = 252  # annualisation factor of the Sharpe ratio


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rmse(a, p) -> Column:
    return F.sqrt(F.avg(F.pow(_c(a) - _c(p), 2)))


def mse(a, p) -> Column:
    return F.avg(F.pow(_c(a) - _c(p), 2))


def mae(a, p) -> Column:
    return F.avg(F.abs(_c(a) - _c(p)))


def directional_accuracy(a, p) -> Column:
    """Share of rows whose signs agree; zero counts as its own sign (0 == 0 is a hit)."""
    return F.avg((F.signum(_c(a)) == F.signum(_c(p))).cast("double"))


def r2(a, p) -> Column:
    """Coefficient of determination; constant actuals give 1 when perfect, else 0."""
    a, p = _c(a), _c(p)
    ss_res = F.sum(F.pow(a - p, 2))
    ss_tot = F.count(a) * F.var_pop(a)
    return (
        F.when(ss_tot > 0, F.lit(1.0) - F.try_divide(ss_res, ss_tot))
        .when(ss_res == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def position(p) -> Column:
    """Long when the forecast is positive, short otherwise (zero is short)."""
    return F.when(_c(p) > 0, F.lit(1.0)).otherwise(F.lit(-1.0))


def strategy_return(a, p) -> Column:
    return position(p) * _c(a)


def sharpe_of(r) -> Column:
    """Annualised Sharpe ratio of a return column (population std); 0 when n<=1 or std=0."""
    r = _c(r)
    sd = F.stddev_pop(r)
    return F.when((F.count(r) > 1) & (sd > 0), F.lit(math.sqrt(TRADING_DAYS)) * F.avg(r) / sd).otherwise(F.lit(0.0))


def sharpe(a, p) -> Column:
    return sharpe_of(strategy_return(a, p))


def win_rate(a, p) -> Column:
    return F.avg((strategy_return(a, p) > 0).cast("double"))


def buy_hold_sharpe(a) -> Column:
    return sharpe_of(_c(a))


def std_ratio(a, p) -> Column:
    """Population std of the forecast over sample std of the actual."""
    return F.try_divide(F.stddev_pop(_c(p)), F.stddev_samp(_c(a)))


def residual_mean(a, p) -> Column:
    return F.avg(_c(a) - _c(p))


def residual_std(a, p) -> Column:
    return F.stddev_samp(_c(a) - _c(p))


STANDARD = {
    "rmse": rmse,
    "mae": mae,
    "directional_accuracy": directional_accuracy,
}

FULL = {
    "rmse": rmse,
    "mae": mae,
    "r2": r2,
    "directional_accuracy": directional_accuracy,
    "sharpe_ratio": sharpe,
    "win_rate": win_rate,
}
