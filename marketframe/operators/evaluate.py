"""Forecast evaluation tables.

Inputs are long prediction frames ``(group..., actual, pred)``; outputs are one
row per group. Every table is a single hash aggregate with map-side partial
aggregation, so a group holding a third of all rows is pre-reduced on every
executor before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.functions.columns import corr_safe
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
BIAS_THRESHOLD = 0.001
PIPS_PER_UNIT = 10000
ERROR_BINS = 30


def _valid(df: DataFrame, actual: str, pred: str) -> DataFrame:
    return df.filter(F.col(actual).isNotNull() & F.col(pred).isNotNull())


def evaluate(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred",
             metrics: Mapping[str, Callable[[Column, Column], Column]] = M.STANDARD) -> DataFrame:
    """AG-09/10/11/12: one row per group with the requested metrics (and ``n``)."""
    a, p = F.col(actual), F.col(pred)
    aggs = [F.count(F.lit(1)).alias("n")] + [fn(a, p).alias(name) for name, fn in metrics.items()]
    return _valid(df, actual, pred).groupBy(*by).agg(*aggs)


def regression_metrics(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred") -> DataFrame:
    """AG-09/10/11: RMSE, MAE, R² and directional accuracy."""
    return evaluate(df, by, actual, pred, {"rmse": M.rmse, "mae": M.mae, "r2": M.r2,
                                           "directional_accuracy": M.directional_accuracy})


def trading_metrics(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred") -> DataFrame:
    """AG-12: long/short strategy mean return, annualised Sharpe and win rate."""
    a, p = F.col(actual), F.col(pred)
    return _valid(df, actual, pred).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(M.strategy_return(a, p)).alias("mean_strategy_return"),
        M.sharpe(a, p).alias("sharpe_ratio"),
        M.win_rate(a, p).alias("win_rate"),
    )


def buy_and_hold(df: DataFrame, by: Sequence[str], actual: str = "actual") -> DataFrame:
    """AG-13: buy-and-hold Sharpe (position always 1) and total compounded return."""
    a = F.col(actual)
    return df.filter(a.isNotNull()).groupBy(*by).agg(
        M.buy_hold_sharpe(a).alias("buy_hold_sharpe"),
        (F.product(F.lit(1.0) + a) - F.lit(1.0)).alias("buy_hold_return"),
    )


def residual_report(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred") -> DataFrame:
    """AG-14: residual mean / sample std and a bias flag (|mean| > 0.001)."""
    a, p = F.col(actual), F.col(pred)
    out = _valid(df, actual, pred).groupBy(*by).agg(
        M.residual_mean(a, p).alias("residual_mean"), M.residual_std(a, p).alias("residual_std"))
    return out.withColumn("biased", F.abs(F.col("residual_mean")) > F.lit(BIAS_THRESHOLD))


def direction_confusion(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred") -> DataFrame:
    """AG-15: 2x2 direction confusion with labels [1, -1]; rows with a zero sign are
    excluded. Long form ``(by..., actual_dir, pred_dir, n)`` with all four cells."""
    a, p = F.signum(F.col(actual)), F.signum(F.col(pred))
    d = _valid(df, actual, pred).filter((a != 0) & (p != 0)).select(
        *by, a.cast("bigint").alias("actual_dir"), p.cast("bigint").alias("pred_dir"))
    counts = d.groupBy(*by, "actual_dir", "pred_dir").agg(F.count(F.lit(1)).alias("n"))
    # pivot to the fixed label order, then back to long form so absent cells are 0
    wide = counts.groupBy(*by, "actual_dir").pivot("pred_dir", [1, -1]).agg(F.first("n"))
    long = wide.select(*by, "actual_dir",
                       F.expr("stack(2, 1L, `1`, -1L, `-1`) as (pred_dir, n)"))
    return long.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint"))


def backtest_price_error(df: DataFrame, by: Sequence[str], price: str = "close",
                         pred_price: str = "pred_price") -> DataFrame:
    """AG-16: mean absolute price error and the same in pips (x10000)."""
    err = F.abs(F.col(price) - F.col(pred_price))
    return df.groupBy(*by).agg(
        F.avg(err).alias("price_mae"), (F.avg(err) * F.lit(PIPS_PER_UNIT)).alias("mae_pips"))


def prediction_diagnostics(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred",
                           today: str = "ret") -> DataFrame:
    """AG-18: std ratio pred/actual (pop/sample) and correlation of the forecast with
    today's return (NULL when either side is constant)."""
    a, p = F.col(actual), F.col(pred)
    return _valid(df, actual, pred).groupBy(*by).agg(
        M.std_ratio(a, p).alias("std_ratio"), corr_safe(p, F.col(today)).alias("corr_today"))


def model_comparison(df: DataFrame, model: str = "model", by: Sequence[str] = (), actual: str = "actual",
                     pred: str = "pred") -> DataFrame:
    """AG-19: one row per model with all metrics, plus the best model by DA and by
    Sharpe (ties -> model name ascending) per ``by`` group."""
    table = evaluate(df, [*by, model], actual, pred, M.FULL)
    # the metric table has one row per model, so this window is small
    w = Window.partitionBy(*by)
    return table.withColumns({
        "best_by_da": F.min_by(model, F.struct(-F.col("directional_accuracy"), F.col(model))).over(w),
        "best_by_sharpe": F.min_by(model, F.struct(-F.col("sharpe_ratio"), F.col(model))).over(w),
    })


def error_histogram(df: DataFrame, by: Sequence[str], actual: str = "actual", pred: str = "pred",
                    bins: int = ERROR_BINS) -> DataFrame:
    """AG-07 applied to prediction errors (30 bins per model)."""
    from marketframe.operators.stats import histogram
    errs = _valid(df, actual, pred).withColumn("error", F.col(actual) - F.col(pred))
    return histogram(errs, "error", bins, by)


def hit_flags(df: DataFrame, actual: str = "actual", pred: str = "pred", n: int | None = None,
              spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """AU-12: per-row direction hit flag, optionally on the last ``n`` rows only."""
    from marketframe.operators.rows import last_n
    d = last_n(df, n, spec) if n else df
    return d.withColumn("hit", F.signum(F.col(actual)) == F.signum(F.col(pred)))
