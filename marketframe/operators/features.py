"""Window features.

Every feature is a window expression over ``spec.window()``
(``partitionBy(keys).orderBy(order)``), so a whole feature set plans as one
Exchange on the series key plus local sorts; derived-over-derived features (RSI,
ATR, volatility of returns) stack further Window nodes on the same distribution.
For one very large series use :mod:`marketframe.operators.layout` (halo blocks)
and pass the blocked spec it returns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions.columns import (
    pct_change,
    rolling_guarded,
    rolling_mean,
    rolling_std,
    safe_div,
)
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
MA_WINDOWS = (5, 10, 20, 50)
RETURN_PERIODS = (5, 20)
RETURN_LAGS = (1, 2, 3, 5)
VOL_WINDOWS = (5, 20)
RSI_WINDOW = 14
ATR_WINDOW = 14
VOL_RATIO_EPS = 1e-10
SUPERSET_FEATURES = [
    "ret", "ma_5", "ma_10", "ma_20", "ma_50", "ret_5d", "ret_20d",
    "lag_1", "lag_2", "lag_3", "lag_5", "open", "high", "low", "close",
]
EXTENDED_FEATURES = [
    "close", "high", "low", "open", "ret", "ma_50", "range_pct", "atr_14",
    "vol_5d", "vol_20d", "vol_ratio", "ret_20d", "lag_1", "lag_2", "lag_3", "lag_5",
]


def returns(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, col: str = "close", out: str = "ret") -> DataFrame:
    """WN-01: one-period simple return."""
    return df.withColumn(out, pct_change(col, 1, spec))


def period_returns(df: DataFrame, periods: Sequence[int] = RETURN_PERIODS, spec: SeriesSpec = DEFAULT_SPEC,
                   col: str = "close") -> DataFrame:
    """WN-02: n-period returns ``ret_{n}d``."""
    return df.withColumns({f"ret_{n}d": pct_change(col, n, spec) for n in periods})


def lags(df: DataFrame, lags_: Sequence[int] = RETURN_LAGS, spec: SeriesSpec = DEFAULT_SPEC,
         col: str = "ret", prefix: str = "lag") -> DataFrame:
    """WN-03: lagged copies ``lag_{k}`` of a column."""
    w = spec.window()
    return df.withColumns({f"{prefix}_{k}": F.lag(col, k).over(w) for k in lags_})


def next_target(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, col: str = "ret", out: str = "target") -> DataFrame:
    """WN-04: next-row value (tomorrow's return) as the label."""
    return df.withColumn(out, F.lead(col, 1).over(spec.window()))


def moving_averages(df: DataFrame, windows: Sequence[int] = MA_WINDOWS, spec: SeriesSpec = DEFAULT_SPEC,
                    col: str = "close", prefix: str = "ma", lag: int = 0) -> DataFrame:
    """WN-05 (and WN-12 with ``lag=1``): trailing means, NULL until the frame is full."""
    suffix = "_prev" if lag else ""
    return df.withColumns({f"{prefix}_{n}{suffix}": rolling_mean(col, n, spec, lag) for n in windows})


def volatility(df: DataFrame, windows: Sequence[int] = VOL_WINDOWS, spec: SeriesSpec = DEFAULT_SPEC,
               col: str = "ret", lag: int = 0) -> DataFrame:
    """WN-06: rolling sample std of returns ``vol_{n}d``."""
    suffix = "_prev" if lag else ""
    return df.withColumns({f"vol_{n}d{suffix}": rolling_std(col, n, spec, lag) for n in windows})


def vol_ratio(df: DataFrame, short: str = "vol_5d", long: str = "vol_20d", out: str = "vol_ratio") -> DataFrame:
    """WN-07: short over long volatility with the reference's epsilon."""
    return df.withColumn(out, F.col(short) / (F.col(long) + F.lit(VOL_RATIO_EPS)))


def diff(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, col: str = "close", out: str = "diff") -> DataFrame:
    """WN-08: first difference."""
    return df.withColumn(out, F.col(col) - F.lag(col, 1).over(spec.window()))


def rsi(df: DataFrame, n: int = RSI_WINDOW, spec: SeriesSpec = DEFAULT_SPEC, col: str = "close",
        out: str | None = None, lag: int = 0) -> DataFrame:
    """WN-09: relative strength index over ``n`` rows."""
    # materialise the delta first so the rolling means run on a plain column
    w = spec.window()
    tmp = "__delta"
    d = df.withColumn(tmp, F.col(col) - F.lag(col, 1).over(w))
    gain = F.when(F.col(tmp) > 0, F.col(tmp)).otherwise(F.lit(0.0))
    loss = F.when(F.col(tmp) < 0, -F.col(tmp)).otherwise(F.lit(0.0))
    d = d.withColumns({"__gain": gain, "__loss": loss})
    frame = spec.rows(-(n - 1) - lag, -lag)
    g = rolling_guarded(F.avg, "__gain", frame, n)
    lo = rolling_guarded(F.avg, "__loss", frame, n)
    name = out or (f"rsi_{n}" + ("_prev" if lag else ""))
    value = (
        F.when(lo > 0, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / lo))
        .when((lo == 0) & (g > 0), F.lit(100.0))
    )
    return d.withColumn(name, value).drop(tmp, "__gain", "__loss")


def price_range(df: DataFrame) -> DataFrame:
    """PF-15: intraday range and range as a share of close."""
    rng = F.col("high") - F.col("low")
    return df.withColumns({"range": rng, "range_pct": safe_div(rng, F.col("close"))})


def true_range(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, out: str = "true_range") -> DataFrame:
    """WN-10: max(h-l, |h-prev close|, |l-prev close|); NULL on the first row (NaN
    propagates in the reference while ``greatest`` would skip it)."""
    pc = F.lag("close", 1).over(spec.window())
    h, lo = F.col("high"), F.col("low")
    tr = F.greatest(h - lo, F.abs(h - pc), F.abs(lo - pc))
    ok = pc.isNotNull() & h.isNotNull() & lo.isNotNull()
    return df.withColumn(out, F.when(ok, tr))


def atr(df: DataFrame, n: int = ATR_WINDOW, spec: SeriesSpec = DEFAULT_SPEC, col: str = "true_range",
        lag: int = 0) -> DataFrame:
    """WN-11: simple-mean average true range."""
    if col not in df.columns:
        df = true_range(df, spec, col)
    return df.withColumn(f"atr_{n}" + ("_prev" if lag else ""), rolling_mean(col, n, spec, lag))


def lookahead_safe(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ma_windows: Sequence[int] = (5, 20),
                   vol_windows: Sequence[int] = (5, 20), rsi_n: int = RSI_WINDOW) -> DataFrame:
    """WN-12: indicators whose frame ends at the previous row (indicator shifted by
    one), computed directly with ``rowsBetween(-n, -1)`` instead of a second window."""
    out = moving_averages(df, ma_windows, spec, lag=1)
    if "ret" in out.columns:
        out = volatility(out, vol_windows, spec, lag=1)
    return rsi(out, rsi_n, spec, lag=1)


def equity_curve(df: DataFrame, ret_col: str, spec: SeriesSpec = DEFAULT_SPEC, out: str = "equity") -> DataFrame:
    """WN-13: compounded growth ``prod(1 + r)`` up to the current row (negative
    factors are handled, unlike exp(sum(log)))."""
    return df.withColumn(out, F.product(F.lit(1.0) + F.col(ret_col)).over(spec.cumulative()))


def forward_returns(df: DataFrame, horizons: Sequence[int] = (1, 5, 10), spec: SeriesSpec = DEFAULT_SPEC,
                    col: str = "close", within: str | None = "split") -> DataFrame:
    """WN-14: forward cumulative return ``close_{t+h}/close_t - 1``; with ``within``
    the window is also keyed by that column so it never crosses a split boundary."""
    s = spec.with_keys(within) if within and within in df.columns else spec
    w = s.window()
    return df.withColumns({f"fwd_ret_{h}": safe_div(F.lead(col, h).over(w), F.col(col)) - F.lit(1.0)
                           for h in horizons})


def sequences(df: DataFrame, features: Sequence[str], steps: int, spec: SeriesSpec = DEFAULT_SPEC,
              within: str | None = "split", out: str = "window", keep_incomplete: bool = False) -> DataFrame:
    """WN-15: the last ``steps`` rows of ``features`` as ``ARRAY<ARRAY<DOUBLE>>`` per row
    (oldest first), label at the last row. Rows without a full window are dropped
    unless ``keep_incomplete`` (then ``window`` is NULL)."""
    s = spec.with_keys(within) if within and within in df.columns else spec
    frame = s.rows(-(steps - 1), 0)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    full = F.count(F.lit(1)).over(frame) == steps
    d = df.withColumn(out, F.when(full, F.collect_list(vec).over(frame)))
    return d if keep_incomplete else d.filter(F.col(out).isNotNull())


def next_close(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, out: str = "next_close") -> DataFrame:
    """WN-16: actual next close."""
    return df.withColumn(out, F.lead("close", 1).over(spec.window()))


def projected_price(df: DataFrame, pred_col: str, spec: SeriesSpec = DEFAULT_SPEC, out: str = "pred_price") -> DataFrame:
    """WN-17: previous close in the slice times ``1 + prediction``; the first row of a
    slice falls back to its own close."""
    prev = F.lag("close", 1).over(spec.window())
    return df.withColumn(out, F.coalesce(prev * (F.lit(1.0) + F.col(pred_col)), F.col("close")))


def feature_superset(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ma_windows: Sequence[int] = MA_WINDOWS,
                     return_periods: Sequence[int] = RETURN_PERIODS, lag_list: Sequence[int] = RETURN_LAGS,
                     with_target: bool = True) -> DataFrame:
    """WN-18: return, moving averages, n-period returns and lagged returns (+ target).

    One function for training and serving: the training form drops rows with any
    NULL feature or target (:func:`training_rows`), the serving form keeps the latest
    row per series (see ``forecast.next_step``).
    """
    out = returns(df, spec)
    out = moving_averages(out, ma_windows, spec)
    out = period_returns(out, return_periods, spec)
    out = lags(out, lag_list, spec)
    if with_target:
        out = next_target(out, spec)
    return out


def extended_features(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ma_windows: Sequence[int] = MA_WINDOWS,
                      with_target: bool = True) -> DataFrame:
    """WN-19: superset plus RSI, range, true range / ATR and volatilities."""
    out = feature_superset(df, spec, ma_windows, with_target=with_target)
    out = rsi(out, RSI_WINDOW, spec)
    out = price_range(out)
    out = true_range(out, spec)
    out = atr(out, ATR_WINDOW, spec)
    out = volatility(out, VOL_WINDOWS, spec)
    return vol_ratio(out)


def superset_names(ma_windows: Sequence[int] = MA_WINDOWS, return_periods: Sequence[int] = RETURN_PERIODS,
                   lag_list: Sequence[int] = RETURN_LAGS, ohlc: bool = True) -> list[str]:
    names = ["ret"] + [f"ma_{n}" for n in ma_windows] + [f"ret_{n}d" for n in return_periods]
    names += [f"lag_{k}" for k in lag_list]
    if ohlc:
        names += ["open", "high", "low", "close"]
    return names


def training_rows(df: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """Training form: drop rows with a NULL feature or target."""
    return df.na.drop(how="any", subset=list(features) + [target])
