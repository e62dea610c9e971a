"""Dedupe, ordering, per-series limits and chronological splits.

Per-series limits use ``row_number`` over the series window with a ``<= n``
filter, which Spark plans as a window-group limit (partial top-k before the
shuffle). Splits are computed from a row number and the series count, both over
the same series distribution, so they add no Exchange to a feature plan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
TRAIN_FRACTION = 0.8


def dedupe_keep_last(df: DataFrame, keys: Sequence[str] = ("symbol", "ts"),
                     precedence: Sequence[str] = ("_prec", "_file", "_row")) -> DataFrame:
    """SL-01: one row per key; the row with the greatest ``precedence`` tuple wins.

    Expressed as an aggregate ``max_by(struct(row), struct(precedence))`` per key so the
    shuffle carries partially aggregated rows: a hot key (many copies of one bar)
    is reduced map-side instead of landing whole in one task.
    """
    prec = [c for c in precedence if c in df.columns]
    if not prec:
        raise ValueError("dedupe needs at least one precedence column present")
    payload = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(*prec)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in payload])


def sort_by_time(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """SL-02: total order for sinks only; windows never need a global sort."""
    return df.orderBy(*spec.keys, *spec.order)


def last_n(df: DataFrame, n: int, spec: SeriesSpec = DEFAULT_SPEC, rank_col: str | None = None) -> DataFrame:
    """SL-03: the last ``n`` rows of every series (window-group limit)."""
    rn = F.row_number().over(spec.window_desc())
    out = df.withColumn("__rn", rn).filter(F.col("__rn") <= n)
    if rank_col:
        return out.withColumnRenamed("__rn", rank_col)
    return out.drop("__rn")


def latest_row(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """SL-04: the latest row per series as a hash aggregate ``max_by(row, order)``
    (partial aggregation, so a huge series is reduced before the shuffle)."""
    payload = [c for c in df.columns if c not in spec.keys]
    picked = df.groupBy(*spec.keys).agg(F.max_by(F.struct(*payload), F.struct(*spec.order)).alias("__row"))
    return picked.select(*spec.keys, *[F.col(f"__row.{c}").alias(c) for c in payload])


def top_k_abs(df: DataFrame, value: str, k: int, name: str = "feature", by: Sequence[str] = ()) -> DataFrame:
    """SL-05: top ``k`` rows by ``|value|`` (ties by name); per group when ``by`` is given."""
    order = [F.abs(F.col(value)).desc(), F.col(name).asc()]
    if not by:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def position_cols(spec: SeriesSpec = DEFAULT_SPEC) -> dict[str, Column]:
    """1-based row position and series length, both over the series distribution."""
    return {
        "__pos": F.row_number().over(spec.window()),
        "__n": F.count(F.lit(1)).over(spec.whole()),
    }


def split_fraction(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, fraction: float = TRAIN_FRACTION,
                   out: str = "split") -> DataFrame:
    """SL-06: first ``floor(n * fraction)`` rows of each series are ``train``, the rest ``test``."""
    d = df.withColumns(position_cols(spec))
    cut = F.floor(F.col("__n") * F.lit(float(fraction)))
    return d.withColumn(out, F.when(F.col("__pos") <= cut, F.lit("train")).otherwise(F.lit("test"))).drop(
        "__pos", "__n")


def date_column(day) -> Column:
    """A date, a time or their text as a column."""
    return F.lit(day) if isinstance(day, (_dt.date, _dt.datetime)) else F.to_timestamp(F.lit(str(day)))


def split_at_date(df: DataFrame, test_start, spec: SeriesSpec = DEFAULT_SPEC, fraction: float = TRAIN_FRACTION,
                  out: str = "split") -> DataFrame:
    """SL-07: rows before ``test_start`` are train; a series that ends before the date
    falls back to the fractional split (per series)."""
    start = date_column(test_start)
    d = df.withColumns(position_cols(spec)).withColumn("__max", F.max(spec.time).over(spec.whole()))
    cut = F.floor(F.col("__n") * F.lit(float(fraction)))
    by_fraction = F.when(F.col("__pos") <= cut, F.lit("train")).otherwise(F.lit("test"))
    by_date = F.when(F.col(spec.time) < start, F.lit("train")).otherwise(F.lit("test"))
    return d.withColumn(out, F.when(F.col("__max") < start, by_fraction).otherwise(by_date)).drop(
        "__pos", "__n", "__max")


def drop_null_target(df: DataFrame, target: str = "target", emergency: Sequence[str] | None = None) -> DataFrame:
    """SL-08: drop rows whose label is NULL (the last row of each series); with
    ``emergency`` also drop rows with a NULL in those columns."""
    out = df.filter(F.col(target).isNotNull())
    return out.na.drop(subset=list(emergency)) if emergency else out


def rows_between(df: DataFrame, first: int, last: int, spec: SeriesSpec = DEFAULT_SPEC,
                 pos_col: str = "pos") -> DataFrame:
    """SL-09: rows at 1-based positions ``first..last`` of every series (audit samples)."""
    return df.withColumn(pos_col, F.row_number().over(spec.window()).cast("bigint")).filter(
        F.col(pos_col).between(first, last))
