"""Panels derived from the driver tables (test-data adapters, see FIXTURES.md §B).

* ``ticks``   - ``events`` as one series per ``user_id``: close = value.
* ``bars_1h`` - ``events`` bucketed per ``(event_type, hour)`` into OHLCV bars.
* ``daily``   - ``orders`` per ``(o_orderpriority, o_orderdate)``: close = avg price.

All three read only the columns they need, so the Parquet scan prunes columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, positive_only: bool = True) -> DataFrame:
    """``(symbol, ts, seq, close)``; ``positive_only`` applies the price filter (PF-05)."""
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("close"),
    )
    return ev.filter(F.col("close") > 0) if positive_only else ev


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLCV bars per event type: ``(symbol, ts, seq, open, high, low, close, volume)``.

    One hash aggregate with partial (map-side) aggregation; ``min_by``/``max_by`` on
    ``struct(ts, event_id)`` give a deterministic first/last tick.
    """
    ev = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    return (
        ev.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("ts"))
        .agg(
            F.min("event_id").alias("seq"),
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily average order price per priority: ``(symbol, ts, seq, close)``."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("ts")
    ).agg(F.lit(0).cast("bigint").alias("seq"), F.avg("o_totalprice").alias("close"))
