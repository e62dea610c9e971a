"""Registry of named queries over the driver tables, each with an optional DuckDB
oracle SQL string. ``__spark_entry__`` exposes both dicts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def register(name: str, sql: str | None = None, covers: Sequence[str] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; the result is
    passed through :func:`finish` so doubles are rounded like the oracle."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the oracle is time-zone naive; pin the session zone used by casts
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        COVERS[name] = tuple(covers)
        return run

    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round DOUBLE columns (``+0.0`` folds -0.0) and widen integers to BIGINT so the
    schema and values compare equal to the DuckDB oracle."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = (F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            # dates travel as timestamps: pandas turns DuckDB DATE into datetime64
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


# ---------------------------------------------------------------- SQL helpers
W = "PARTITION BY symbol ORDER BY ts, seq"

TICKS = ("ticks AS (SELECT user_id AS symbol, ts, event_id AS seq, value AS close "
         "FROM events WHERE value > 0)")
BARS = ("bars AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, min(event_id) AS seq, "
        "arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, "
        "arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume "
        "FROM events GROUP BY 1, 2)")
DAILY = ("daily AS (SELECT o_orderpriority AS symbol, o_orderdate AS ts, CAST(0 AS BIGINT) AS seq, "
         "avg(o_totalprice) AS close FROM orders GROUP BY 1, 2)")


def rounded(sql: str, cols: Sequence[str], digits: int = 6) -> str:
    """Wrap a SELECT so the named DOUBLE columns are rounded like :func:`finish`."""
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def roll(agg: str, col: str, n: int, lag: int = 0, part: str = W) -> str:
    """SQL twin of ``rolling_guarded``: NULL until ``n`` non-null values are in frame."""
    lo, hi = n - 1 + lag, lag
    hi_s = "CURRENT ROW" if hi == 0 else f"{hi} PRECEDING"
    frame = f"OVER ({part} ROWS BETWEEN {lo} PRECEDING AND {hi_s})"
    return f"CASE WHEN count({col}) {frame} = {n} THEN {agg}({col}) {frame} END"


def pct(col: str, n: int, part: str = W) -> str:
    return f"({col} / nullif(lag({col}, {n}) OVER ({part}), 0) - 1)"
