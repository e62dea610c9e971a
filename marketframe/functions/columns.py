"""Column -> Column helpers that encode the pandas edge semantics in
built-in Spark expressions, so everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from marketframe.spec import SeriesSpec


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """Division that yields NULL (never an ANSI error, never inf) on a zero divisor."""
    return F.try_divide(_c(num), _c(den))


def rolling_guarded(agg, col, frame: WindowSpec, n: int) -> Column:
    """``agg(col)`` over ``frame`` but only when ``n`` non-null values are in frame
    (pandas ``rolling(n)`` with ``min_periods=n``)."""
    c = _c(col)
    return F.when(F.count(c).over(frame) == n, agg(c).over(frame))


def rolling_mean(col, n: int, spec: SeriesSpec, lag: int = 0) -> Column:
    """Trailing mean of ``n`` rows; ``lag=1`` gives the look-ahead-safe variant whose
    frame ends at the previous row (same as shifting the indicator by one)."""
    frame = spec.rows(-(n - 1) - lag, -lag)
    return rolling_guarded(F.avg, col, frame, n)


def rolling_std(col, n: int, spec: SeriesSpec, lag: int = 0) -> Column:
    """Trailing sample standard deviation (ddof=1) of ``n`` rows."""
    frame = spec.rows(-(n - 1) - lag, -lag)
    return rolling_guarded(F.stddev_samp, col, frame, n)


def pct_change(col, n: int, spec: SeriesSpec) -> Column:
    """``x_t / x_{t-n} - 1``; NULL for the first ``n`` rows and on a zero base."""
    c = _c(col)
    return safe_div(c, F.lag(c, n).over(spec.window())) - F.lit(1.0)


def null_if_not_finite(col) -> Column:
    """NaN and +-inf become NULL."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def corr_safe(a, b) -> Column:
    """Pearson correlation as an aggregate, NULL when either side is constant.

    Spark's ``corr`` raises under ANSI when a variance is zero; pandas returns NaN.
    Computed over rows where both sides are non-null (pairwise complete).
    """
    a, b = _c(a), _c(b)
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    den = F.stddev_samp(aa) * F.stddev_samp(bb)
    return F.when(den > 0, safe_div(F.covar_samp(aa, bb), den))


def r6(col, digits: int = 6) -> Column:
    """Round for stable comparison; ``+ 0.0`` folds a negative zero into zero."""
    return F.round(_c(col), digits) + F.lit(0.0)
