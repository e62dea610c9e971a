"""Registered queries: the minimum slice and window features on the tick panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.operators import clean, evaluate as ev, features as wn, forecast, rows
from marketframe.plans import train
from marketframe.plans.registry import BARS, TICKS, W, pct, register, roll, rounded
from marketframe.sources import panels

# ----------------------------------------------------------------- SQL twins
TICK_FEATURES_SQL = f"""{TICKS},
tf0 AS (SELECT *, {pct('close', 1)} AS ret, {roll('avg', 'close', 5)} AS ma_5,
               {roll('avg', 'close', 10)} AS ma_10 FROM ticks),
tf AS (SELECT *, lag(ret, 1) OVER ({W}) AS lag_1, lag(ret, 2) OVER ({W}) AS lag_2,
              lag(ret, 3) OVER ({W}) AS lag_3, lag(ret, 5) OVER ({W}) AS lag_5,
              lead(ret, 1) OVER ({W}) AS target FROM tf0),
tt0 AS (SELECT * FROM tf WHERE ret IS NOT NULL AND ma_5 IS NOT NULL AND ma_10 IS NOT NULL
        AND lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND lag_5 IS NOT NULL
        AND target IS NOT NULL),
tt AS (SELECT * EXCLUDE (pos, n),
              CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER ({W}) AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM tt0))"""

DA_SQL = "avg(CASE WHEN sign({a}) = sign({p}) THEN 1.0 ELSE 0.0 END)"


def da_sql(a: str, p: str) -> str:
    return DA_SQL.format(a=a, p=p)


# ----------------------------------------------------------------- queries
@register(
    "ml11_naive_baseline_ticks",
    rounded(f"""WITH {TICK_FEATURES_SQL}
SELECT symbol, count(*) AS n, sqrt(avg(pow(target - ret, 2))) AS rmse, avg(abs(target - ret)) AS mae,
       {da_sql('target', 'ret')} AS directional_accuracy
FROM tt WHERE split = 'test' GROUP BY symbol""", ["rmse", "mae", "directional_accuracy"]),
    covers=("PF-05", "WN-01", "WN-03", "WN-04", "WN-05", "SL-06", "AG-09", "AG-11", "ML-11"),
)
def naive_baseline_ticks(spark, sf_dir):
    """How good is tomorrow = today, per series, on the test split?"""
    t = forecast.naive_prediction(train.tick_training_frame(spark, sf_dir))
    return ev.evaluate(t.filter(F.col("split") == "test"), ["symbol"])


@register(
    "wn01_returns_ticks",
    rounded(f"""WITH {TICKS}
SELECT symbol, ts, seq, close, {pct('close', 1)} AS ret, close - lag(close, 1) OVER ({W}) AS diff,
       lead(close, 1) OVER ({W}) AS next_close FROM ticks""", ["close", "ret", "diff", "next_close"]),
    covers=("WN-01", "WN-08", "WN-16", "PF-05"),
)
def returns_ticks(spark, sf_dir):
    t = panels.ticks(spark, sf_dir)
    return wn.next_close(wn.diff(wn.returns(t)))


@register(
    "wn18_feature_superset_ticks",
    rounded(f"""WITH {TICK_FEATURES_SQL}
SELECT symbol, ts, seq, close, ret, ma_5, ma_10, lag_1, lag_2, lag_3, lag_5, target FROM tf""",
            ["close", "ret", "ma_5", "ma_10", "lag_1", "lag_2", "lag_3", "lag_5", "target"]),
    covers=("WN-01", "WN-03", "WN-04", "WN-05", "WN-18"),
)
def feature_superset_ticks(spark, sf_dir):
    t = panels.ticks(spark, sf_dir)
    return train.tick_features(t)


SUPERSET = wn.superset_names(ohlc=False)
SUPERSET_SQL = ", ".join(
    [f"{pct('close', 1)} AS ret"] + [f"{roll('avg', 'close', n)} AS ma_{n}" for n in wn.MA_WINDOWS] + [f"{pct('close', n)} AS ret_{n}d" for n in wn.RETURN_PERIODS])
LAGS_SQL = ", ".join([f"lag(ret, {k}) OVER ({W}) AS lag_{k}" for k in wn.RETURN_LAGS] + [f"lead(ret, 1) OVER ({W}) AS target"])


@register(
    "wn18_full_superset_ticks",
    rounded(f"""WITH {TICKS},
f AS (SELECT *, {SUPERSET_SQL} FROM ticks)
SELECT symbol, ts, seq, close, {', '.join(c for c in SUPERSET if not c.startswith('lag_'))}, {LAGS_SQL} FROM f""", ["close", *SUPERSET, "target"]),
    covers=("WN-18", "WN-02"),
)
def full_superset_ticks(spark, sf_dir):
    """All eleven features of the superset that come from a price, of every series."""
    return wn.feature_superset(panels.ticks(spark, sf_dir)).select("symbol", "ts", "seq", "close", *SUPERSET, "target")


@register(
    "wn18_full_superset_bars",
    rounded(f"""WITH {BARS},
f AS (SELECT *, {SUPERSET_SQL} FROM bars WHERE close > 0)
SELECT symbol, ts, seq, {', '.join(c for c in SUPERSET if not c.startswith('lag_'))}, open, high, low, close, {LAGS_SQL} FROM f""",
            ["open", "high", "low", "close", *SUPERSET, "target"]),
    covers=("WN-18", "WN-02"),
)
def full_superset_bars(spark, sf_dir):
    """The superset's fifteen features, prices included, and the target."""
    from marketframe.operators import clean
    f = wn.feature_superset(clean.positive_prices(panels.bars_1h(spark, sf_dir)))
    return f.select("symbol", "ts", "seq", *wn.superset_names(), "target")


@register(
    "sl06_split_ticks",
    f"""WITH {TICK_FEATURES_SQL}
SELECT symbol, split, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM tt GROUP BY symbol, split""",
    covers=("SL-06", "PF-03", "SL-08"),
)
def split_ticks(spark, sf_dir):
    t = train.tick_training_frame(spark, sf_dir)
    return t.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                            F.max("ts").alias("last_ts"))


@register(
    "ag12_trading_metrics_ticks",
    rounded(f"""WITH {TICK_FEATURES_SQL},
s AS (SELECT symbol, split, target AS a, CASE WHEN ret > 0 THEN 1.0 ELSE -1.0 END * target AS r FROM tt)
SELECT symbol, split, count(*) AS n, avg(r) AS mean_strategy_return,
       CASE WHEN count(r) > 1 AND stddev_pop(r) > 0 THEN sqrt(252) * avg(r) / stddev_pop(r) ELSE 0.0 END
         AS sharpe_ratio,
       avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END) AS win_rate
FROM s GROUP BY symbol, split""", ["mean_strategy_return", "sharpe_ratio", "win_rate"]),
    covers=("AG-12", "ML-11"),
)
def trading_metrics_ticks(spark, sf_dir):
    t = forecast.naive_prediction(train.tick_training_frame(spark, sf_dir))
    return ev.trading_metrics(t, ["symbol", "split"])


@register(
    "ag10_regression_metrics_ticks",
    rounded(f"""WITH {TICK_FEATURES_SQL}
SELECT symbol, split, count(*) AS n, sqrt(avg(pow(target - ret, 2))) AS rmse, avg(abs(target - ret)) AS mae,
       CASE WHEN count(*) * var_pop(target) > 0 THEN 1 - sum(pow(target - ret, 2)) / (count(*) * var_pop(target))
            WHEN sum(pow(target - ret, 2)) = 0 THEN 1.0 ELSE 0.0 END AS r2,
       {da_sql('target', 'ret')} AS directional_accuracy
FROM tt GROUP BY symbol, split""", ["rmse", "mae", "r2", "directional_accuracy"]),
    covers=("AG-09", "AG-10", "AG-11"),
)
def regression_metrics_ticks(spark, sf_dir):
    t = forecast.naive_prediction(train.tick_training_frame(spark, sf_dir))
    return ev.regression_metrics(t, ["symbol", "split"])


@register(
    "ml12_zero_baseline_ticks",
    rounded(f"""WITH {TICK_FEATURES_SQL}
SELECT symbol, count(*) AS n, sqrt(avg(pow(target, 2))) AS rmse, avg(abs(target)) AS mae
FROM tt WHERE split = 'test' GROUP BY symbol""", ["rmse", "mae"]),
    covers=("ML-12", "AG-09"),
)
def zero_baseline_ticks(spark, sf_dir):
    t = train.tick_training_frame(spark, sf_dir).filter(F.col("split") == "test")
    t = t.withColumns({"actual": F.col("target"), "pred": F.lit(0.0)})
    return ev.evaluate(t, ["symbol"], metrics={"rmse": M.rmse, "mae": M.mae})


@register(
    "pf05_positive_filter_ticks",
    """SELECT user_id AS symbol, CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count_if(value > 0) AS BIGINT) AS rows_kept FROM events GROUP BY user_id""",
    covers=("PF-05",),
)
def positive_filter_ticks(spark, sf_dir):
    raw = panels.ticks(spark, sf_dir, positive_only=False)
    return raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_in"),
                                     F.count_if(F.col("close") > 0).alias("rows_kept"))


@register(
    "sl03_last_n_ticks",
    rounded(f"""WITH {TICKS}
SELECT symbol, ts, seq, close, CAST(rn AS BIGINT) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn FROM ticks) WHERE rn <= 30""",
            ["close"]),
    covers=("SL-03",),
)
def last_n_ticks(spark, sf_dir):
    return rows.last_n(panels.ticks(spark, sf_dir), 30, rank_col="rn")


@register(
    "sl04_latest_row_ticks",
    rounded(f"""WITH {TICKS}
SELECT symbol, arg_max(ts, (ts, seq)) AS ts, arg_max(seq, (ts, seq)) AS seq, arg_max(close, (ts, seq)) AS close
FROM ticks GROUP BY symbol""", ["close"]),
    covers=("SL-04",),
)
def latest_row_ticks(spark, sf_dir):
    return rows.latest_row(panels.ticks(spark, sf_dir))


@register(
    "pf12_nonfinite_to_null_ticks",
    rounded(f"""WITH {TICKS},
r AS (SELECT symbol, ts, seq, CASE WHEN close > 400 THEN CAST('Infinity' AS DOUBLE)
                                   WHEN close < 1 THEN CAST('NaN' AS DOUBLE)
                                   WHEN close < 2 THEN CAST('-Infinity' AS DOUBLE) ELSE close END AS x FROM ticks)
SELECT symbol, ts, seq, CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END AS x FROM r""", ["x"]),
    covers=("PF-12",),
)
def nonfinite_to_null_ticks(spark, sf_dir):
    """Data-derived NaN / +-inf values (as produced by unguarded ratios) become NULL."""
    t = panels.ticks(spark, sf_dir)
    c = F.col("close")
    x = (F.when(c > 400, F.lit(float("inf"))).when(c < 1, F.lit(float("nan")))
         .when(c < 2, F.lit(float("-inf"))).otherwise(c))
    return clean.non_finite_to_null(t.select("symbol", "ts", "seq", x.alias("x")), ["x"])
