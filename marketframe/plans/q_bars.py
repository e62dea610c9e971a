"""Registered queries: extended window features, evaluation and audits on the hourly
bar panel (5 long series)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.operators import evaluate as ev, features as wn, rows
from marketframe.plans import train
from marketframe.plans.registry import BARS, W, pct, register, roll, rounded
from marketframe.sources import panels
from marketframe.spec import DEFAULT_SPEC

EXT = wn.EXTENDED_FEATURES

BAR_FEATURES_SQL = f"""{BARS},
bp AS (SELECT * FROM bars WHERE close > 0),
b0 AS (SELECT *, {pct('close', 1)} AS ret, {roll('avg', 'close', 5)} AS ma_5, {roll('avg', 'close', 10)} AS ma_10,
              {roll('avg', 'close', 20)} AS ma_20, {roll('avg', 'close', 50)} AS ma_50,
              {pct('close', 5)} AS ret_5d, {pct('close', 20)} AS ret_20d,
              close - lag(close, 1) OVER ({W}) AS d__,
              high - low AS range, (high - low) / nullif(close, 0) AS range_pct,
              CASE WHEN lag(close, 1) OVER ({W}) IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
                   THEN greatest(high - low, abs(high - lag(close, 1) OVER ({W})),
                                 abs(low - lag(close, 1) OVER ({W}))) END AS true_range
       FROM bp),
b1 AS (SELECT *, lag(ret, 1) OVER ({W}) AS lag_1, lag(ret, 2) OVER ({W}) AS lag_2, lag(ret, 3) OVER ({W}) AS lag_3,
              lag(ret, 5) OVER ({W}) AS lag_5, lead(ret, 1) OVER ({W}) AS target,
              CASE WHEN d__ > 0 THEN d__ ELSE 0.0 END AS g__, CASE WHEN d__ < 0 THEN -d__ ELSE 0.0 END AS l__,
              {roll('avg', 'true_range', 14)} AS atr_14, {roll('stddev_samp', 'ret', 5)} AS vol_5d,
              {roll('stddev_samp', 'ret', 20)} AS vol_20d
       FROM b0),
b2 AS (SELECT *, {roll('avg', 'g__', 14)} AS ga__, {roll('avg', 'l__', 14)} AS la__,
              vol_5d / (vol_20d + 1e-10) AS vol_ratio FROM b1),
bf AS (SELECT * EXCLUDE (d__, g__, l__, ga__, la__),
              CASE WHEN la__ > 0 THEN 100 - 100 / (1 + ga__ / la__) WHEN la__ = 0 AND ga__ > 0 THEN 100.0 END
                AS rsi_14 FROM b2)"""

_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in EXT + ["target"])
BAR_TRAIN_SQL = f"""{BAR_FEATURES_SQL},
bt0 AS (SELECT *, ret AS ret_unscaled, close AS close_unscaled FROM bf WHERE {_NOT_NULL}),
bt AS (SELECT * EXCLUDE (pos__, n__),
              CASE WHEN pos__ <= floor(n__ * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER ({W}) AS pos__, count(*) OVER (PARTITION BY symbol) AS n__ FROM bt0))"""

# three reference-free predictors of the next return: naive, zero and the mean of the last 5 returns
PRED_SQL = f"""{BAR_TRAIN_SQL},
preds AS (
  SELECT symbol, ts, seq, split, ret, target AS actual, 'naive' AS model, ret AS pred FROM bt
  UNION ALL SELECT symbol, ts, seq, split, ret, target, 'zero', 0.0 FROM bt
  UNION ALL SELECT symbol, ts, seq, split, ret, target, 'ma5',
         avg(ret) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) FROM bt)"""

ALL_BAR_COLS = ["open", "high", "low", "close", "volume", "ret", "ma_5", "ma_10", "ma_20", "ma_50", "ret_5d",
                "ret_20d", "range", "range_pct", "true_range", "lag_1", "lag_2", "lag_3", "lag_5", "target",
                "atr_14", "vol_5d", "vol_20d", "vol_ratio", "rsi_14"]


def bar_predictions(spark, sf_dir):
    """Long prediction frame ``(symbol, ts, seq, split, ret, actual, model, pred)``."""
    t = train.bar_training_frame(spark, sf_dir)
    base = t.select("symbol", "ts", "seq", "split", "ret", F.col("target").alias("actual"), F.avg("ret").over(DEFAULT_SPEC.last(5)).alias("ma5"))
    models = [F.struct(F.lit(m).alias("model"), p.alias("pred")) for m, p in (("naive", F.col("ret")), ("zero", F.lit(0.0)), ("ma5", F.col("ma5")))]
    return base.select("symbol", "ts", "seq", "split", "ret", "actual", F.inline(F.array(*models)))


@register("wn19_extended_features_bars",
          rounded(f"WITH {BAR_FEATURES_SQL}\nSELECT * FROM bf", ALL_BAR_COLS),
          covers=("WN-02", "WN-05", "WN-06", "WN-07", "WN-09", "WN-10", "WN-11", "WN-19", "PF-15"))
def extended_features_bars(spark, sf_dir):
    return train.bar_features(spark, sf_dir)


@register("wn12_lookahead_safe_bars",
          rounded(f"""WITH {BAR_FEATURES_SQL},
s0 AS (SELECT *, close - lag(close, 1) OVER ({W}) AS d__ FROM bf),
s1 AS (SELECT *, CASE WHEN d__ > 0 THEN d__ ELSE 0.0 END AS g__, CASE WHEN d__ < 0 THEN -d__ ELSE 0.0 END AS l__
       FROM s0),
s2 AS (SELECT symbol, ts, seq, {roll('avg', 'close', 5, 1)} AS ma_5_prev, {roll('avg', 'close', 20, 1)} AS ma_20_prev,
              {roll('stddev_samp', 'ret', 5, 1)} AS vol_5d_prev, {roll('stddev_samp', 'ret', 20, 1)} AS vol_20d_prev,
              {roll('avg', 'g__', 14, 1)} AS ga__, {roll('avg', 'l__', 14, 1)} AS la__ FROM s1)
SELECT * EXCLUDE (ga__, la__),
       CASE WHEN la__ > 0 THEN 100 - 100 / (1 + ga__ / la__) WHEN la__ = 0 AND ga__ > 0 THEN 100.0 END AS rsi_14_prev
FROM s2""", ["ma_5_prev", "ma_20_prev", "vol_5d_prev", "vol_20d_prev", "rsi_14_prev"]),
          covers=("WN-12",))
def lookahead_safe_bars(spark, sf_dir):
    f = wn.lookahead_safe(train.bar_features(spark, sf_dir))
    return f.select("symbol", "ts", "seq", "ma_5_prev", "ma_20_prev", "vol_5d_prev", "vol_20d_prev", "rsi_14_prev")


@register("wn13_equity_curve_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
s AS (SELECT symbol, ts, seq, target, CASE WHEN ret > 0 THEN 1.0 ELSE -1.0 END * target AS strat
      FROM bt WHERE split = 'test')
SELECT symbol, ts, seq,
       product(1 + strat) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS equity,
       product(1 + target) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS buy_hold_equity
FROM s""", ["equity", "buy_hold_equity"]),
          covers=("WN-13", "AG-13"))
def equity_curve_bars(spark, sf_dir):
    t = train.bar_training_frame(spark, sf_dir).filter(F.col("split") == "test")
    t = t.withColumn("strat", M.strategy_return("target", "ret"))
    t = wn.equity_curve(t, "strat")
    t = wn.equity_curve(t, "target", out="buy_hold_equity")
    return t.select("symbol", "ts", "seq", "equity", "buy_hold_equity")


@register("wn14_forward_returns_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, ts, seq, split,
       lead(close, 1) OVER (PARTITION BY symbol, split ORDER BY ts, seq) / close - 1 AS fwd_ret_1,
       lead(close, 5) OVER (PARTITION BY symbol, split ORDER BY ts, seq) / close - 1 AS fwd_ret_5,
       lead(close, 10) OVER (PARTITION BY symbol, split ORDER BY ts, seq) / close - 1 AS fwd_ret_10
FROM bt""", ["fwd_ret_1", "fwd_ret_5", "fwd_ret_10"]),
          covers=("WN-14",))
def forward_returns_bars(spark, sf_dir):
    t = wn.forward_returns(train.bar_training_frame(spark, sf_dir), (1, 5, 10))
    return t.select("symbol", "ts", "seq", "split", "fwd_ret_1", "fwd_ret_5", "fwd_ret_10")


SEQ_FEATURES = ["ret", "rsi_14", "range_pct"]
SEQ_STEPS = 5


def _seq_sql() -> str:
    part = "PARTITION BY symbol, split ORDER BY ts, seq"
    steps = []
    for k in range(SEQ_STEPS - 1, -1, -1):
        cells = [f"printf('%.6f', round(lag({c}, {k}) OVER ({part}), 6) + 0.0)" for c in SEQ_FEATURES]
        steps.append(" || ',' || ".join(cells))
    body = " || ';' || ".join(steps)
    return f"""WITH {BAR_TRAIN_SQL},
s AS (SELECT symbol, ts, seq, split, target, count(*) OVER ({part} ROWS BETWEEN {SEQ_STEPS - 1} PRECEDING AND CURRENT ROW)
             AS c__, {body} AS window_text FROM bt)
SELECT symbol, ts, seq, split, target, window_text FROM s WHERE c__ = {SEQ_STEPS}"""


@register("wn15_sequences_bars", rounded(_seq_sql(), ["target"]), covers=("WN-15",))
def sequences_bars(spark, sf_dir):
    t = wn.sequences(train.bar_training_frame(spark, sf_dir), SEQ_FEATURES, SEQ_STEPS)
    fmt = F.transform("window", lambda a: F.array_join(
        F.transform(a, lambda x: F.format_string("%.6f", F.round(x, 6) + F.lit(0.0))), ","))
    return t.select("symbol", "ts", "seq", "split", "target", F.array_join(fmt, ";").alias("window_text"))


@register("wn17_backtest_price_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn FROM bt)
      WHERE rn <= 60),
p AS (SELECT symbol, ts, seq, close,
             coalesce(lag(close, 1) OVER ({W}) * (1 + ret), close) AS pred_price FROM l)
SELECT symbol, avg(abs(close - pred_price)) AS price_mae, avg(abs(close - pred_price)) * 10000 AS mae_pips
FROM p GROUP BY symbol""", ["price_mae", "mae_pips"]),
          covers=("WN-17", "SL-03", "AG-16"))
def backtest_price_bars(spark, sf_dir):
    t = rows.last_n(train.bar_training_frame(spark, sf_dir), 60)
    t = wn.projected_price(t, "ret")
    return ev.backtest_price_error(t, ["symbol"])


@register("ag13_buy_and_hold_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, split,
       CASE WHEN count(target) > 1 AND stddev_pop(target) > 0 THEN sqrt(252) * avg(target) / stddev_pop(target)
            ELSE 0.0 END AS buy_hold_sharpe,
       product(1 + target) - 1 AS buy_hold_return
FROM bt GROUP BY symbol, split""", ["buy_hold_sharpe", "buy_hold_return"]),
          covers=("AG-13",))
def buy_and_hold_bars(spark, sf_dir):
    return ev.buy_and_hold(train.bar_training_frame(spark, sf_dir), ["symbol", "split"], actual="target")


@register("ag14_residuals_bars",
          rounded(f"""WITH {PRED_SQL}
SELECT symbol, model, avg(actual - pred) AS residual_mean, stddev_samp(actual - pred) AS residual_std,
       abs(avg(actual - pred)) > 0.001 AS biased
FROM preds WHERE split = 'test' AND pred IS NOT NULL GROUP BY symbol, model""", ["residual_mean", "residual_std"]),
          covers=("AG-14",))
def residuals_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return ev.residual_report(p, ["symbol", "model"])


@register("ag15_direction_confusion_bars",
          f"""WITH {PRED_SQL},
c AS (SELECT symbol, model, CAST(sign(actual) AS BIGINT) AS actual_dir, CAST(sign(pred) AS BIGINT) AS pred_dir
      FROM preds WHERE split = 'test' AND pred IS NOT NULL AND actual IS NOT NULL
        AND sign(actual) <> 0 AND sign(pred) <> 0),
cells AS (SELECT DISTINCT symbol, model, actual_dir FROM c),
grid AS (SELECT symbol, model, actual_dir, pd AS pred_dir FROM cells, (VALUES (1), (-1)) v(pd))
SELECT g.symbol, g.model, g.actual_dir, CAST(g.pred_dir AS BIGINT) AS pred_dir,
       CAST(count(c.actual_dir) AS BIGINT) AS n
FROM grid g LEFT JOIN c ON g.symbol = c.symbol AND g.model = c.model AND g.actual_dir = c.actual_dir
  AND g.pred_dir = c.pred_dir
GROUP BY g.symbol, g.model, g.actual_dir, g.pred_dir""",
          covers=("AG-15",))
def direction_confusion_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return ev.direction_confusion(p, ["symbol", "model"])


@register("ag18_prediction_diagnostics_bars",
          rounded(f"""WITH {PRED_SQL},
v AS (SELECT * FROM preds WHERE split = 'test' AND pred IS NOT NULL AND actual IS NOT NULL)
SELECT symbol, model, stddev_pop(pred) / nullif(stddev_samp(actual), 0) AS std_ratio,
       CASE WHEN stddev_samp(pred) * stddev_samp(ret) > 0
            THEN covar_samp(pred, ret) / (stddev_samp(pred) * stddev_samp(ret)) END AS corr_today
FROM v GROUP BY symbol, model""", ["std_ratio", "corr_today"]),
          covers=("AG-18",))
def prediction_diagnostics_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return ev.prediction_diagnostics(p, ["symbol", "model"])


_FULL_SQL = """count(*) AS n, sqrt(avg(pow(actual - pred, 2))) AS rmse, avg(abs(actual - pred)) AS mae,
       CASE WHEN count(*) * var_pop(actual) > 0 THEN 1 - sum(pow(actual - pred, 2)) / (count(*) * var_pop(actual))
            WHEN sum(pow(actual - pred, 2)) = 0 THEN 1.0 ELSE 0.0 END AS r2,
       avg(CASE WHEN sign(actual) = sign(pred) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       CASE WHEN count(*) > 1 AND stddev_pop(CASE WHEN pred > 0 THEN 1.0 ELSE -1.0 END * actual) > 0
            THEN sqrt(252) * avg(CASE WHEN pred > 0 THEN 1.0 ELSE -1.0 END * actual)
                 / stddev_pop(CASE WHEN pred > 0 THEN 1.0 ELSE -1.0 END * actual) ELSE 0.0 END AS sharpe_ratio,
       avg(CASE WHEN CASE WHEN pred > 0 THEN 1.0 ELSE -1.0 END * actual > 0 THEN 1.0 ELSE 0.0 END) AS win_rate"""
FULL_COLS = ["rmse", "mae", "r2", "directional_accuracy", "sharpe_ratio", "win_rate"]


@register("ag19_model_comparison_bars",
          rounded(f"""WITH {PRED_SQL},
m AS (SELECT symbol, model, {_FULL_SQL}
      FROM preds WHERE split = 'test' AND pred IS NOT NULL AND actual IS NOT NULL GROUP BY symbol, model)
SELECT *, arg_min(model, (-directional_accuracy, model)) OVER (PARTITION BY symbol) AS best_by_da,
          arg_min(model, (-sharpe_ratio, model)) OVER (PARTITION BY symbol) AS best_by_sharpe
FROM m""", FULL_COLS),
          covers=("AG-19", "JN-09", "AG-09", "AG-10", "AG-11", "AG-12"))
def model_comparison_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return ev.model_comparison(p, "model", ["symbol"])


@register("ag07_error_histogram_bars",
          rounded(f"""WITH {PRED_SQL},
e AS (SELECT model, actual - pred AS error FROM preds WHERE split = 'test' AND pred IS NOT NULL
      AND actual IS NOT NULL),
b AS (SELECT model, error, min(error) OVER (PARTITION BY model) AS lo0, max(error) OVER (PARTITION BY model) AS hi0
      FROM e),
c AS (SELECT *, CASE WHEN hi0 = lo0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN hi0 = lo0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM b),
d AS (SELECT model, lo, (hi - lo) / 30.0 AS w, CAST(least(floor((error - lo) / ((hi - lo) / 30.0)), 29) AS BIGINT) AS bin
      FROM c)
SELECT model, bin, any_value(lo) + bin * any_value(w) AS bin_lo, any_value(lo) + (bin + 1) * any_value(w) AS bin_hi,
       count(*) AS n
FROM d GROUP BY model, bin""", ["bin_lo", "bin_hi"]),
          covers=("AG-07",))
def error_histogram_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return ev.error_histogram(p, ["model"])


@register("au12_hit_flags_bars",
          rounded(f"""WITH {PRED_SQL}
SELECT symbol, ts, seq, model, actual, pred, sign(actual) = sign(pred) AS hit FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, model ORDER BY ts DESC, seq DESC) AS rn
  FROM preds WHERE split = 'test') WHERE rn <= 30""", ["actual", "pred"]),
          covers=("AU-12",))
def hit_flags_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir).filter(F.col("split") == "test")
    out = ev.hit_flags(p, n=30, spec=DEFAULT_SPEC.with_keys("model"))
    return out.select("symbol", "ts", "seq", "model", "actual", "pred", "hit")


@register("wn19_extended_features_halo_bars",
          rounded(f"WITH {BAR_FEATURES_SQL}\nSELECT * FROM bf", ALL_BAR_COLS),
          covers=("WN-19",))
def extended_features_halo_bars(spark, sf_dir):
    """Same features through the halo-block layout used for a series too large for
    one task: 200-row blocks with the look-back that the features need and a 1-row look-ahead."""
    from marketframe.operators import clean, layout
    b = clean.positive_prices(panels.bars_1h(spark, sf_dir))
    blocked, spec = layout.halo_blocks(b, lookback=layout.lookback_for(ALL_BAR_COLS), lookahead=1, block_rows=200, chunk="day")
    out = layout.drop_halo(wn.extended_features(blocked, spec))
    return out.select("symbol", "ts", "seq", *ALL_BAR_COLS)
