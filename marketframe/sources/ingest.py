"""Ingest planning over a stored history.

All of these are per-series aggregates or pushable filters; the current time and
"today" are parameters (never read from the clock inside a plan) so results are
reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.operators.rows import dedupe_keep_last
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
MIN_ROWS = 250          # about one trading year
MAX_AGE_HOURS = 24
BACKFILL_YEARS = 5
DAYS_PER_YEAR = 365


def _ts(value) -> F.Column:
    if isinstance(value, F.Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        return F.lit(value).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(str(value)))


def lookback(df: DataFrame, as_of, days: int, col: str = "ts") -> DataFrame:
    """IO-15: rows with ``ts >= as_of - days``; a plain comparison against a literal,
    so it is pushed into the Parquet scan."""
    start = _ts(as_of) - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(col) >= start)


def freshness(df: DataFrame, now, spec: SeriesSpec = DEFAULT_SPEC, max_age_hours: int = MAX_AGE_HOURS,
              min_rows: int = MIN_ROWS) -> DataFrame:
    """IO-17: per series latest timestamp, row count, age in hours and the gate
    ``is_current and rows > min_rows`` (skip the download)."""
    out = df.groupBy(*spec.keys).agg(F.max(spec.time).alias("latest"), F.count(F.lit(1)).alias("rows"))
    age = (F.unix_micros(_ts(now).cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / 3.6e9
    out = out.withColumn("age_hours", age)
    out = out.withColumns({
        "is_current": F.col("age_hours") < F.lit(float(max_age_hours)),
        "sufficient": F.col("rows") > F.lit(min_rows),
    })
    return out.withColumn("skip", F.col("is_current") & F.col("sufficient"))


def incremental_plan(df: DataFrame, now, spec: SeriesSpec = DEFAULT_SPEC, universe: DataFrame | None = None,
                     max_age_hours: int = MAX_AGE_HOURS, min_rows: int = MIN_ROWS,
                     years: int = BACKFILL_YEARS) -> DataFrame:
    """IO-16: one plan row per series ``(action, fetch_from, fetch_to)``.

    ``skip`` when fresh and sufficient; ``backfill`` of ``years*365`` days when the
    series is unknown or has fewer than ``min_rows`` rows; ``up_to_date`` when the
    day after the latest row is not before today; else ``incremental`` from that day.
    ``universe`` (one row per wanted series) adds series with no history.
    """
    f = freshness(df, now, spec, max_age_hours, min_rows)
    if universe is not None:
        f = universe.select(*spec.keys).join(f, list(spec.keys), "left")
    now_c = _ts(now)
    today = F.to_date(now_c)
    start = F.date_add(F.to_date("latest"), 1)
    backfill = F.col("latest").isNull() | (F.col("rows") < F.lit(min_rows))
    action = (F.when(F.coalesce(F.col("skip"), F.lit(False)), F.lit("skip"))
              .when(backfill, F.lit("backfill"))
              .when(start >= today, F.lit("up_to_date"))
              .otherwise(F.lit("incremental")))
    fetch_from = (F.when(action == "backfill", F.to_date(now_c - F.make_dt_interval(F.lit(years * DAYS_PER_YEAR))))
                  .when(action == "incremental", start))
    fetch_to = F.when(action.isin("backfill", "incremental"), today)
    return f.select(*spec.keys, "latest", F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
                    action.alias("action"), fetch_from.alias("fetch_from"), fetch_to.alias("fetch_to"))


def upsert(history: DataFrame, new: DataFrame, keys: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """IO-18: merge new rows into the history; on equal keys the new row wins."""
    h = history.withColumn("_prec", F.lit(0))
    n = new.withColumn("_prec", F.lit(1))
    merged = h.unionByName(n, allowMissingColumns=True)
    return dedupe_keep_last(merged, keys, ("_prec",)).drop("_prec")
