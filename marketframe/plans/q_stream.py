"""Registered queries: incremental file-stream ingest and late corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.operators import features as wn
from marketframe.plans.q_io import daily_dates
from marketframe.plans.registry import DAILY, ORACLE, register, rounded, roll
from marketframe.session import checkpoint, scratch_dir
from marketframe.sources import files
from marketframe.spec import SeriesSpec
from marketframe.streaming import ingest

CORRECTION_START = "2001-07-01"
DATE_SPEC = SeriesSpec(keys=("symbol",), order=("Date",), time="Date")


def _ingest_two_batches(spark, sf_dir, root):
    d = daily_dates(spark, sf_dir)
    src, table, ck = f"{root}/src", f"{root}/table", f"{root}/ck"
    year = F.year("Date")
    files.write_range_partitions(d.filter(year < 2000), f"{src}/b1", year)
    ingest.run_ingest(spark, src, table, ck)
    files.write_range_partitions(d.filter(year >= 2000), f"{src}/b2", year)
    ingest.run_ingest(spark, src, table, ck)
    return d, src, table, ck


@register("ss01_stream_ingest_daily",
          rounded(f"""WITH {DAILY}
SELECT symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS Date, close AS Close FROM daily""", ["Close"]),
          covers=("SS-01", "IO-07", "IO-18"))
def stream_ingest_daily(spark, sf_dir):
    """Two arrivals of range files, each processed by an availableNow file stream
    that upserts into the history table: the table equals the batch load."""
    root = scratch_dir(spark, "stream")
    _, _, table, _ = _ingest_two_batches(spark, sf_dir, root)
    return spark.read.parquet(table).select("symbol", "Date", "Close")


def _features(df):
    out = wn.returns(df, DATE_SPEC, col="Close")
    return wn.moving_averages(out, (5,), DATE_SPEC, col="Close")


@register("ss02_late_corrections_daily",
          rounded(f"""WITH {DAILY},
c AS (SELECT symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS Date,
             CASE WHEN ts >= TIMESTAMP '{CORRECTION_START} 00:00:00' THEN close * 1.05 ELSE close END AS Close FROM daily),
f AS (SELECT *, Close / nullif(lag(Close, 1) OVER (PARTITION BY symbol ORDER BY Date), 0) - 1 AS ret,
             {roll('avg', 'Close', 5, part='PARTITION BY symbol ORDER BY Date')} AS ma_5 FROM c)
SELECT symbol, Date, Close, ret, ma_5 FROM f WHERE Date >= TIMESTAMP '{CORRECTION_START} 00:00:00'""",
                  ["Close", "ret", "ma_5"]),
          covers=("SS-02", "SL-01"))
def late_corrections_daily(spark, sf_dir):
    """A later file revises bars already ingested: the stream replaces them (no
    watermark drop) and features are recomputed for touched series from the first
    changed bar, reading 5 earlier rows as context."""
    root = scratch_dir(spark, "late")
    d, src, table, ck = _ingest_two_batches(spark, sf_dir, root)
    before = checkpoint(spark.read.parquet(table))
    fix = d.filter(F.col("Date") >= F.lit(CORRECTION_START)).withColumn("Close", F.col("Close") * 1.05)
    files.write_range_partitions(fix, f"{src}/b3", F.lit(0))
    ingest.run_ingest(spark, src, table, ck)
    after = spark.read.parquet(table).select("symbol", "Date", "Close")
    changed = ingest.changed_since(before, after)
    out = ingest.recompute_from(after, changed, _features, lookback=5)
    return out.select("symbol", "Date", "Close", "ret", "ma_5")


@register("ss02_recomputed_partitions_daily", ORACLE["ss02_late_corrections_daily"], covers=("SS-02", "SS-01"))
def recomputed_partitions_daily(spark, sf_dir):
    """The same corrections on a stored feature table: only the partitions from the change on are
    rewritten, and only they and the look-back's are read."""
    root = scratch_dir(spark, "late")
    d, src, table, ck = _ingest_two_batches(spark, sf_dir, root)
    before, features = checkpoint(spark.read.parquet(table)), f"{root}/features"
    every = before.groupBy("symbol").agg(F.min("Date").alias("first_changed"))
    ingest.recompute_partitions(spark, table, features, every, _features, 5)
    fix = d.filter(F.col("Date") >= F.lit(CORRECTION_START)).withColumn("Close", F.col("Close") * 1.05)
    files.write_range_partitions(fix, f"{src}/b3", F.lit(0))
    ingest.run_ingest(spark, src, table, ck)
    changed = ingest.changed_since(before, spark.read.parquet(table).select("symbol", "Date", "Close"))
    ingest.recompute_partitions(spark, table, features, changed, _features, 5)
    return spark.read.parquet(features).where(F.col("Date") >= F.lit(CORRECTION_START)).select("symbol", "Date", "Close", "ret", "ma_5")
