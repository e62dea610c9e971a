"""Registered queries: cleaning, dedupe, splits, scaling, joins and ingest planning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketframe.operators import clean, features as wn, joins, rows, scale
from marketframe.plans import train
from marketframe.plans.q_bars import BAR_FEATURES_SQL, BAR_TRAIN_SQL
from marketframe.session import checkpoint
from marketframe.plans.registry import DAILY, TICKS, W, register, rounded
from marketframe.sources import ingest, panels
from marketframe.spec import DEFAULT_SPEC

EXT = wn.EXTENDED_FEATURES
AS_OF = dt.datetime(2001, 8, 1, 18, 0, 0)
DATE_SPLIT_TICKS = dt.datetime(2024, 1, 29, 12, 0, 0)
DATE_SPLIT_DAILY = dt.datetime(2000, 1, 1)


def _scaled_sql(cols, src="bt"):
    parts = []
    for c in cols:
        lo = f"min(CASE WHEN split = 'train' THEN {c} END) OVER (PARTITION BY symbol)"
        hi = f"max(CASE WHEN split = 'train' THEN {c} END) OVER (PARTITION BY symbol)"
        parts.append(f"({c} - {lo}) / CASE WHEN {hi} = {lo} THEN 1.0 ELSE {hi} - {lo} END AS {c}")
    keep = ", ".join(parts)
    return f"SELECT symbol, ts, seq, split, target, ret_unscaled, close_unscaled, {keep} FROM {src}"


SCALED_SQL = f"""{BAR_TRAIN_SQL},
sc AS ({_scaled_sql(EXT)})"""


def scaled_bars(spark, sf_dir, transform=scale.transform_minmax):
    t = train.bar_training_frame(spark, sf_dir)
    s = transform(t, EXT)
    return s.select("symbol", "ts", "seq", "split", "target", "ret_unscaled", "close_unscaled", *EXT)


@register("fs02_minmax_scale_bars",
          rounded(f"WITH {SCALED_SQL}\nSELECT * FROM sc", EXT + ["target", "ret_unscaled", "close_unscaled"]),
          covers=("FS-02", "PF-14"))
def minmax_scale_bars(spark, sf_dir):
    return scaled_bars(spark, sf_dir)


@register("fs01_scaler_table_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
u AS (UNPIVOT (SELECT symbol, {', '.join(EXT)} FROM bt WHERE split = 'train')
      ON {', '.join(EXT)} INTO NAME feature VALUE v)
SELECT symbol, feature, min(v) AS min, max(v) AS max FROM u GROUP BY symbol, feature""", ["min", "max"]),
          covers=("FS-01",))
def scaler_table_bars(spark, sf_dir):
    return scale.fit_minmax(train.bar_training_frame(spark, sf_dir), EXT)


@register("fs03_inverse_roundtrip_bars",
          f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS rows_restored FROM bt GROUP BY symbol""",
          covers=("FS-03",))
def inverse_roundtrip_bars(spark, sf_dir):
    """Scale with a stored scaler table, then invert: every value must come back
    (to 1e-9 relative)."""
    t = train.bar_training_frame(spark, sf_dir)
    cols = ["close", "ret", "atr_14"]
    sc = scale.fit_minmax(t, cols)
    s = scale.transform_minmax(t, cols, scaler=sc)
    back = scale.inverse_minmax(s.select("symbol", "ts", *[F.col(c).alias(c) for c in cols]), cols, sc)
    orig = t.select("symbol", "ts", *[F.col(c).alias(f"o_{c}") for c in cols])
    j = back.join(orig, ["symbol", "ts"])
    ok = None
    for c in cols:
        cond = F.abs(F.col(c) - F.col(f"o_{c}")) <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(F.col(f"o_{c}")))
        ok = cond if ok is None else ok & cond
    return j.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("rows_restored"))


@register("au08_scaled_range_bars",
          rounded(f"""WITH {SCALED_SQL},
u AS (UNPIVOT (SELECT symbol, split, {', '.join(EXT)} FROM sc) ON {', '.join(EXT)} INTO NAME feature VALUE v)
SELECT symbol, split, feature, min(v) AS min, max(v) AS max, min(v) >= 0 AND max(v) <= 1 AS in_unit_range
FROM u GROUP BY symbol, split, feature""", ["min", "max"]),
          covers=("AU-08",))
def scaled_range_bars(spark, sf_dir):
    from marketframe.operators import audit
    return audit.scaled_range(scaled_bars(spark, sf_dir), EXT, ["symbol", "split"])


@register("sl01_dedupe_keep_last_ticks",
          rounded(f"""WITH {TICKS},
copies AS (
  SELECT symbol, ts, seq, close, 0 AS _prec, 'merged' AS _file, seq AS _row FROM ticks
  UNION ALL SELECT symbol, ts, seq, close * 1.01, 1, 'data_2024-01-31_from_2024-01-01', seq FROM ticks
  UNION ALL SELECT symbol, ts, seq, close * 1.02, 1, 'data_2024-01-31_from_2024-01-15', seq FROM ticks
    WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
SELECT symbol, ts, arg_max(seq, (_prec, _file, _row)) AS seq, arg_max(close, (_prec, _file, _row)) AS close,
       arg_max(_file, (_prec, _file, _row)) AS _file
FROM copies GROUP BY symbol, ts""", ["close"]),
          covers=("SL-01", "JN-10", "IO-18"))
def dedupe_keep_last_ticks(spark, sf_dir):
    t = panels.ticks(spark, sf_dir)
    merged = t.withColumns({"_prec": F.lit(0), "_file": F.lit("merged"), "_row": F.col("seq")})
    a = t.withColumns({"close": F.col("close") * 1.01, "_prec": F.lit(1),
                       "_file": F.lit("data_2024-01-31_from_2024-01-01"), "_row": F.col("seq")})
    b = t.filter(F.col("ts") >= F.lit(dt.datetime(2024, 1, 15))).withColumns(
        {"close": F.col("close") * 1.02, "_prec": F.lit(1), "_file": F.lit("data_2024-01-31_from_2024-01-15"),
         "_row": F.col("seq")})
    d = rows.dedupe_keep_last(joins.concat([merged, a, b]), ("symbol", "ts"), ("_prec", "_file", "_row"))
    return d.select("symbol", "ts", "seq", "close", "_file")


@register("sl07_date_split_ticks",
          f"""WITH {TICKS},
p AS (SELECT *, row_number() OVER ({W}) AS pos, count(*) OVER (PARTITION BY symbol) AS n,
             max(ts) OVER (PARTITION BY symbol) AS mx FROM ticks),
s AS (SELECT symbol, ts, CASE WHEN mx < TIMESTAMP '{DATE_SPLIT_TICKS}'
                         THEN CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END
                         ELSE CASE WHEN ts < TIMESTAMP '{DATE_SPLIT_TICKS}' THEN 'train' ELSE 'test' END END AS split
      FROM p)
SELECT symbol, split, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM s GROUP BY symbol, split""",
          covers=("SL-07",))
def date_split_ticks(spark, sf_dir):
    s = rows.split_at_date(panels.ticks(spark, sf_dir), DATE_SPLIT_TICKS)
    return s.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                            F.max("ts").alias("last_ts"))


@register("sl07_date_split_daily",
          f"""WITH {DAILY}
SELECT symbol, CASE WHEN ts < TIMESTAMP '{DATE_SPLIT_DAILY}' THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM daily GROUP BY 1, 2""",
          covers=("SL-07",))
def date_split_daily(spark, sf_dir):
    s = rows.split_at_date(panels.daily(spark, sf_dir), DATE_SPLIT_DAILY)
    return s.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                            F.max("ts").alias("last_ts"))


@register("sl09_rows_between_ticks",
          rounded(f"""WITH {TICKS}
SELECT symbol, ts, seq, close, pos FROM (SELECT *, CAST(row_number() OVER ({W}) AS BIGINT) AS pos FROM ticks)
WHERE pos BETWEEN 5 AND 8""", ["close"]),
          covers=("SL-09",))
def rows_between_ticks(spark, sf_dir):
    return rows.rows_between(panels.ticks(spark, sf_dir), 5, 8)


@register("jn01_align_prices_bars",
          rounded(f"""WITH {SCALED_SQL},
rawb AS (SELECT * FROM bars)
SELECT sc.symbol, sc.ts, sc.split, sc.close AS close_scaled, rawb.close AS raw_close, rawb.volume AS raw_volume
FROM sc JOIN rawb ON sc.symbol = rawb.symbol AND sc.ts = rawb.ts""", ["close_scaled", "raw_close", "raw_volume"]),
          covers=("JN-01",))
def align_prices_bars(spark, sf_dir):
    s = scaled_bars(spark, sf_dir).select("symbol", "ts", "split", F.col("close").alias("close_scaled"))
    out = joins.align_to_prices(s, panels.bars_1h(spark, sf_dir), price_cols=("close", "volume"))
    return out


@register("jn01_unmatched_bars",
          f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, CAST(count(*) AS BIGINT) AS unmatched FROM bt
WHERE NOT EXISTS (SELECT 1 FROM bars WHERE bars.symbol = bt.symbol AND bars.ts = bt.ts AND bars.close > 0)
GROUP BY symbol""",
          covers=("JN-01",))
def unmatched_bars(spark, sf_dir):
    t = train.bar_training_frame(spark, sf_dir)
    prices = clean.positive_prices(panels.bars_1h(spark, sf_dir))
    return joins.unmatched(t, prices).groupBy("symbol").agg(F.count(F.lit(1)).alias("unmatched"))


@register("jn02_valid_target_rows_bars",
          rounded(f"""WITH {BAR_FEATURES_SQL}
SELECT symbol, ts, seq, close FROM bf
WHERE target IS NOT NULL AND EXISTS (SELECT 1 FROM bf AS g WHERE g.symbol = bf.symbol AND g.ts = bf.ts
                                     AND g.ma_50 IS NOT NULL AND g.rsi_14 IS NOT NULL)""", ["close"]),
          covers=("JN-02",))
def valid_target_rows_bars(spark, sf_dir):
    f = train.bar_features(spark, sf_dir)
    with_target = f.filter(F.col("target").isNotNull()).select("symbol", "ts", "seq", "close")
    complete = f.filter(F.col("ma_50").isNotNull() & F.col("rsi_14").isNotNull())
    return joins.intersect_keys(with_target, complete)


@register("jn03_train_test_overlap_ticks",
          f"""WITH {TICKS},
p AS (SELECT *, row_number() OVER ({W}) AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM ticks),
s AS (SELECT symbol, ts, CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM p),
o AS (SELECT symbol, ts FROM s WHERE split = 'train' INTERSECT SELECT symbol, ts FROM s WHERE split = 'test')
SELECT CAST(count(*) AS BIGINT) AS overlapping_keys, count(*) = 0 AS clean FROM o""",
          covers=("JN-03", "AU-02"))
def train_test_overlap_ticks(spark, sf_dir):
    from marketframe.operators import audit
    s = rows.split_fraction(panels.ticks(spark, sf_dir))
    return audit.contamination(s)


@register("jn04_attach_predictions_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT b.symbol, b.ts, b.close, p.pred FROM bars b JOIN
  (SELECT symbol, ts, ret AS pred FROM bt WHERE split = 'test') p ON b.symbol = p.symbol AND b.ts = p.ts""",
                  ["close", "pred"]),
          covers=("JN-04",))
def attach_predictions_bars(spark, sf_dir):
    t = train.bar_training_frame(spark, sf_dir).filter(F.col("split") == "test")
    preds = t.select("symbol", "ts", F.col("ret").alias("pred"))
    return joins.attach_predictions(panels.bars_1h(spark, sf_dir).select("symbol", "ts", "close"), preds)


@register("jn05_tail_align_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
a AS (SELECT symbol, ts, seq, target AS actual, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn
      FROM bt WHERE split = 'test'),
a60 AS (SELECT * FROM a WHERE rn <= 60),
p AS (SELECT symbol, ret AS pred, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn
      FROM bt WHERE split = 'test'),
p50 AS (SELECT * FROM p WHERE rn <= 50)
SELECT a60.symbol, a60.ts, a60.seq, a60.actual, CAST(a60.rn AS BIGINT) AS rn_desc, coalesce(p50.pred, 0.0) AS pred
FROM a60 LEFT JOIN p50 ON a60.symbol = p50.symbol AND a60.rn = p50.rn""", ["actual", "pred"]),
          covers=("JN-05", "ML-10"))
def tail_align_bars(spark, sf_dir):
    return tail_aligned(spark, sf_dir, joins.tail_align)


def tail_aligned(spark, sf_dir, align):
    t = train.bar_training_frame(spark, sf_dir).filter(F.col("split") == "test")
    actual = rows.last_n(t.select("symbol", "ts", "seq", F.col("target").alias("actual")), 60)
    pred = rows.last_n(t.select("symbol", "ts", "seq", F.col("ret").alias("pred")), 50)
    out = align(actual, pred)
    return out.select("symbol", "ts", "seq", "actual", F.col("rn_desc").cast("bigint"), "pred")


@register("pf01_coerce_numeric_events",
          rounded("""SELECT event_id, TRY_CAST(trim(regexp_extract(props, ':([^}]*)', 1)) AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS event_type_num FROM events""", ["k", "event_type_num"]),
          covers=("PF-01",))
def coerce_numeric_events(spark, sf_dir):
    ev = panels.table(spark, sf_dir, "events").select(
        "event_id", F.trim(F.regexp_extract("props", ":([^}]*)", 1)).alias("k"),
        F.col("event_type").alias("event_type_num"))
    return clean.coerce_numeric(ev, ["k", "event_type_num"])


@register("pf02_null_drops_bars",
          f"""WITH {BAR_FEATURES_SQL}
SELECT symbol, CAST(count(*) AS BIGINT) AS rows_all,
       CAST(count_if(ma_50 IS NOT NULL) AS BIGINT) AS rows_subset,
       CAST(count_if(ma_50 IS NOT NULL OR rsi_14 IS NOT NULL OR atr_14 IS NOT NULL) AS BIGINT) AS rows_not_all_null,
       CAST(count_if({' AND '.join(f'{c} IS NOT NULL' for c in ['ret', 'ma_5', 'ma_10', 'ma_20', 'ma_50', 'ret_5d', 'ret_20d', 'lag_1', 'lag_2', 'lag_3', 'lag_5', 'target', 'rsi_14', 'range', 'range_pct', 'true_range', 'atr_14', 'vol_5d', 'vol_20d', 'vol_ratio', 'open', 'high', 'low', 'close', 'volume'])})
            AS BIGINT) AS rows_complete
FROM bf GROUP BY symbol""",
          covers=("PF-02", "PF-03", "PF-04"))
def null_drops_bars(spark, sf_dir):
    f = checkpoint(train.bar_features(spark, sf_dir).drop("seq"))  # four forms of one frame
    counts = [
        f.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_all")),
        clean.drop_null_rows(f, ["ma_50"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_subset")),
        clean.drop_null_rows(f, ["ma_50", "rsi_14", "atr_14"], how="all").groupBy("symbol").agg(
            F.count(F.lit(1)).alias("rows_not_all_null")),
        clean.drop_null_rows(f).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_complete")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.join(c, "symbol", "left")
    return out.na.fill(0)


@register("pf11_truncate_daily",
          rounded(f"""WITH {DAILY}
SELECT symbol, CAST(count(*) AS BIGINT) AS n, max(ts) AS last_ts, avg(close) AS mean_close
FROM daily WHERE ts < TIMESTAMP '2000-07-01 00:00:00' GROUP BY symbol""", ["mean_close"]),
          covers=("PF-11",))
def truncate_daily(spark, sf_dir):
    d = clean.truncate_before(panels.daily(spark, sf_dir), dt.datetime(2000, 7, 1))
    return d.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"),
                                   F.avg("close").alias("mean_close"))


@register("pf13_fill_zero_bars",
          rounded(f"""WITH {BAR_FEATURES_SQL}
SELECT symbol, ts, seq, coalesce(ma_50, 0.0) AS ma_50, coalesce(rsi_14, 0.0) AS rsi_14,
       coalesce(vol_20d, 0.0) AS vol_20d FROM bf""", ["ma_50", "rsi_14", "vol_20d"]),
          covers=("PF-13",))
def fill_zero_bars(spark, sf_dir):
    f = train.bar_features(spark, sf_dir).select("symbol", "ts", "seq", "ma_50", "rsi_14", "vol_20d")
    return clean.fill_zero(f, ["ma_50", "rsi_14", "vol_20d"])


@register("io15_lookback_daily",
          rounded(f"""WITH {DAILY}
SELECT symbol, ts, close FROM daily WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 120 DAY""", ["close"]),
          covers=("IO-15",))
def lookback_daily(spark, sf_dir):
    return ingest.lookback(panels.daily(spark, sf_dir), AS_OF, 120).select("symbol", "ts", "close")


@register("io17_freshness_ticks",
          rounded(f"""WITH {TICKS},
g AS (SELECT symbol, max(ts) AS latest, count(*) AS rows FROM ticks GROUP BY symbol)
SELECT symbol, latest, rows, date_diff('microsecond', latest, TIMESTAMP '2024-01-30 20:00:00') / 3.6e9 AS age_hours,
       date_diff('microsecond', latest, TIMESTAMP '2024-01-30 20:00:00') / 3.6e9 < 24 AS is_current,
       rows > 60 AS sufficient,
       date_diff('microsecond', latest, TIMESTAMP '2024-01-30 20:00:00') / 3.6e9 < 24 AND rows > 60 AS skip
FROM g""", ["age_hours"]),
          covers=("IO-17",))
def freshness_ticks(spark, sf_dir):
    return ingest.freshness(panels.ticks(spark, sf_dir), dt.datetime(2024, 1, 30, 20, 0, 0), min_rows=60)


@register("io16_incremental_plan_ticks",
          f"""WITH {TICKS},
g AS (SELECT symbol, max(ts) AS latest, count(*) AS rows FROM ticks GROUP BY symbol),
f AS (SELECT *, date_diff('microsecond', latest, TIMESTAMP '2024-01-30 20:00:00') / 3.6e9 < 24 AND rows > 60 AS skip,
             CAST(latest AS DATE) + INTERVAL 1 DAY AS start FROM g),
a AS (SELECT *, CASE WHEN skip THEN 'skip' WHEN rows < 60 THEN 'backfill'
                     WHEN CAST(start AS DATE) >= DATE '2024-01-30' THEN 'up_to_date' ELSE 'incremental' END AS action
      FROM f)
SELECT symbol, latest, rows, action,
       CAST(CASE WHEN action = 'backfill' THEN CAST(TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 1825 DAY AS DATE)
            WHEN action = 'incremental' THEN CAST(start AS DATE) END AS TIMESTAMP) AS fetch_from,
       CAST(CASE WHEN action IN ('backfill', 'incremental') THEN DATE '2024-01-30' END AS TIMESTAMP) AS fetch_to
FROM a""",
          covers=("IO-16",))
def incremental_plan_ticks(spark, sf_dir):
    return ingest.incremental_plan(panels.ticks(spark, sf_dir), dt.datetime(2024, 1, 30, 20, 0, 0), min_rows=60)


@register("io18_upsert_daily",
          rounded(f"""WITH {DAILY},
h AS (SELECT symbol, ts, close, 0 AS p FROM daily WHERE ts < TIMESTAMP '2001-01-01 00:00:00'),
n AS (SELECT symbol, ts, close * 1.001 AS close, 1 AS p FROM daily WHERE ts >= TIMESTAMP '2000-12-01 00:00:00')
SELECT symbol, ts, arg_max(close, p) AS close FROM (SELECT * FROM h UNION ALL SELECT * FROM n) GROUP BY symbol, ts""",
                  ["close"]),
          covers=("IO-18", "SS-02"))
def upsert_daily(spark, sf_dir):
    d = panels.daily(spark, sf_dir).select("symbol", "ts", "close")
    hist = d.filter(F.col("ts") < F.lit(dt.datetime(2001, 1, 1)))
    new = d.filter(F.col("ts") >= F.lit(dt.datetime(2000, 12, 1))).withColumn("close", F.col("close") * 1.001)
    return ingest.upsert(hist, new)
