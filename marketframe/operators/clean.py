"""Projections, filters and cleaning. All are narrow
transformations: no shuffle, filters on source columns reach the Parquet scan."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.functions.columns import null_if_not_finite, safe_div

# Fixed values that must equal the reference for equal results.
FEATURE_NAME_PATTERNS = ("lag_", "ma_", "rsi", "atr", "vol", "range")
PRICE_COLUMNS = ("open", "high", "low", "close")
NON_FEATURE_COLUMNS = ("target", "ret_unscaled", "close_unscaled", "target_next_return")


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PF-01: text/number to DOUBLE; unparsable values become NULL (``try_cast``)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as double)") for c in cols if c in df.columns})


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """PF-02 (subset) / PF-03 (any column) / PF-04 (``how='all'``)."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def positive_prices(df: DataFrame, col: str = "close") -> DataFrame:
    """PF-05: keep strictly positive prices (zero/negative would break returns)."""
    return df.filter(F.col(col) > 0)


def drop_if_present(df: DataFrame, names: Iterable[str] = ("volume",), tuple_named: bool = True) -> DataFrame:
    """PF-06: drop named columns and stringified-tuple columns like ``('Close', 'X')``."""
    drop = [c for c in names if c in df.columns]
    if tuple_named:
        drop += [c for c in df.columns if c.startswith("(") and c.endswith(")")]
    return df.drop(*drop)


def normalise_ohlc_names(df: DataFrame) -> DataFrame:
    """PF-07: case-insensitive rename of OHLC(V) columns to lower case."""
    mapping = {c: c.lower() for c in df.columns if c.lower() in PRICE_COLUMNS + ("volume", "date") and c != c.lower()}
    return df.withColumnsRenamed(mapping) if mapping else df


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """PF-08: add absent model features as 0.0 and select them in trained order."""
    cols = [F.col(k) for k in keep]
    cols += [F.col(f).cast("double").alias(f) if f in df.columns else F.lit(0.0).alias(f) for f in features]
    return df.select(*cols)


def present_features(df: DataFrame, configured: Sequence[str]) -> list[str]:
    """PF-09: configured features that exist in the frame, in configured order."""
    have = set(df.columns)
    return [f for f in configured if f in have]


def select_present(df: DataFrame, configured: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *present_features(df, configured))


def features_by_exclusion(columns: Sequence[str], exclude: Sequence[str] = NON_FEATURE_COLUMNS,
                          keys: Sequence[str] = ("symbol", "ts", "seq", "split")) -> list[str]:
    """PF-10: all columns but the label, unscaled copies and keys."""
    skip = set(exclude) | set(keys)
    return [c for c in columns if c not in skip]


def features_by_pattern(columns: Sequence[str], patterns: Sequence[str] = FEATURE_NAME_PATTERNS) -> list[str]:
    """PF-10: technical-indicator columns by name pattern (case-insensitive prefix/contains)."""
    rx = re.compile("|".join(re.escape(p) for p in patterns), re.IGNORECASE)
    return [c for c in columns if rx.search(c)]


def non_price_features(columns: Sequence[str]) -> list[str]:
    """PF-10: features without the raw OHLC prices."""
    return [c for c in columns if c not in PRICE_COLUMNS]


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a list of columns holds: ``(column, non_null, min, max, variance)``, one partial aggregate over the
    listed columns only (the scan reads no others); no columns give no rows."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, non_null bigint, min double, max double, variance double")
    aggs = [F.struct(F.lit(c).alias("column"), F.count(c).alias("non_null"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                     F.var_samp(c).alias("variance")).alias(c) for c in columns]
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def truncate_before(df: DataFrame, cutoff, col: str = "ts") -> DataFrame:
    """PF-11: keep rows strictly before ``cutoff`` (a pushable filter)."""
    return df.filter(F.col(col) < F.lit(cutoff))


def non_finite_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PF-12: NaN and +-inf become NULL."""
    return df.withColumns({c: null_if_not_finite(c) for c in cols})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF-13: NULL -> 0 on (scaled) feature columns."""
    return df.na.fill(0.0, subset=list(cols))


def keep_unscaled(df: DataFrame, cols: Sequence[str] = ("ret", "close")) -> DataFrame:
    """PF-14: keep unscaled copies ``{c}_unscaled`` before scaling."""
    return df.withColumns({f"{c}_unscaled": F.col(c) for c in cols if c in df.columns})
