"""Registered queries: schema-level cleaning on frames derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.operators import clean, rows
from marketframe.plans.q_bars import BAR_FEATURES_SQL
from marketframe.plans.registry import BARS, TICKS, register, rounded
from marketframe.sources import files, panels

CONFIGURED = ["close", "ret", "ma_50", "rsi_14", "sentiment", "open"]


@register("pf06_schema_cleanup_bars",
          rounded(f"""WITH {BARS}
SELECT symbol, ts, open, high, low, close FROM bars""", ["open", "high", "low", "close"]),
          covers=("PF-06", "PF-07", "IO-04", "IO-05"))
def schema_cleanup_bars(spark, sf_dir):
    """Vendor-style column names (upper case, stringified tuples, a duplicate) are
    normalised by name; Volume and tuple-named leftovers are dropped."""
    b = panels.bars_1h(spark, sf_dir)
    raw = b.select("symbol", "ts", F.col("open").alias("Open"), F.col("high").alias("High"),
                   F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"),
                   F.col("close").alias("('Close', 'X')"), F.col("seq").alias("('Ticker', 'X')"))
    named = raw.select("symbol", "ts", "Open", "High", "Low", "Close", "Volume", "('Ticker', 'X')")
    named = clean.normalise_ohlc_names(named)
    named = clean.drop_if_present(named, ("volume",))
    # a frame with a stringified tuple duplicate of Close keeps the first occurrence
    dup = files.dedupe_columns(raw.select("symbol", "ts", "Close", "('Close', 'X')"))
    return named.join(dup.select("symbol", "ts", F.col("Close").alias("__c")), ["symbol", "ts"]).filter(
        F.col("__c") == F.col("close")).drop("__c")


@register("pf09_configured_features_bars",
          rounded(f"""WITH {BAR_FEATURES_SQL}
SELECT symbol, ts, close, ret, ma_50, rsi_14, 0.0 AS sentiment, open FROM bf""",
                  ["close", "ret", "ma_50", "rsi_14", "sentiment", "open"]),
          covers=("PF-08", "PF-09"))
def configured_features_bars(spark, sf_dir):
    """A model's configured feature list against a frame that lacks one of them: the
    present ones are selected in configured order, the absent one is added as 0."""
    from marketframe.plans import train
    f = train.bar_features(spark, sf_dir)
    assert clean.present_features(f, CONFIGURED) == [c for c in CONFIGURED if c != "sentiment"]
    return clean.align_features(f, CONFIGURED, keep=["symbol", "ts"])


@register("io06_flatten_two_level_bars",
          rounded(f"""WITH {BARS}
SELECT symbol, ts AS Date, close AS Close, high AS High
FROM bars""", ["Close", "High"]),
          covers=("IO-06",))
def flatten_two_level_bars(spark, sf_dir):
    """A wide frame with two-level ``field|ticker`` columns (one per event type) flattened
    back to a long panel keyed by ticker."""
    b = panels.bars_1h(spark, sf_dir)
    wide = b.groupBy(F.col("ts").alias("Date")).pivot("symbol").agg(
        F.first("close").alias("Close"), F.first("high").alias("High"))
    # pivot names columns '<ticker>_<field>'; rename to the two-level 'field|ticker' form
    ren = {}
    for c in wide.columns:
        if c == "Date":
            continue
        ticker, field = c.rsplit("_", 1)
        ren[c] = f"{field}|{ticker}"
    wide = wide.withColumnsRenamed(ren)
    long = files.flatten_two_level(wide, "Date").filter(F.col("Close").isNotNull())
    return long.select("symbol", F.col("Date").cast("timestamp_ntz").alias("Date"), "Close", "High")


@register("sl02_sorted_sink_ticks",
          rounded(f"WITH {TICKS}\nSELECT symbol, ts, seq, close FROM ticks", ["close"]),
          covers=("SL-02",))
def sorted_sink_ticks(spark, sf_dir):
    """Total order (symbol, ts, seq) applied once, at the sink."""
    return rows.sort_by_time(panels.ticks(spark, sf_dir))
