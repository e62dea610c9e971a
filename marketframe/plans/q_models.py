"""Registered queries: linear / autoregressive models, scoring, backtest and serving.

One-regressor fits are SQL-checkable (``regr_intercept`` / ``regr_slope``); multi-
feature fits, the ridge grid, ARMA and ADF run rows-only here and are checked
against numpy in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.operators import arma, features as wn, forecast, linear, rows, scale
from marketframe.plans import retrain, train
from marketframe.plans.q_bars import BAR_FEATURES_SQL, BAR_TRAIN_SQL
from marketframe.plans.registry import W, register, rounded

EXT = wn.EXTENDED_FEATURES
ONE = ["ret"]

COEF_SQL = f"""{BAR_TRAIN_SQL},
coef AS (SELECT symbol, count(*) AS n, regr_intercept(target, ret) AS intercept, regr_slope(target, ret) AS slope
         FROM bt WHERE split = 'train' GROUP BY symbol)"""


def bt(spark, sf_dir):
    return train.bar_training_frame(spark, sf_dir)


def one_feature_coefs(t):
    return linear.fit_linear(t.filter(F.col("split") == "train"), ONE, "target", ["symbol"])


@register("ml01_ols_one_feature_bars",
          rounded(f"WITH {COEF_SQL}\nSELECT symbol, n, intercept, slope FROM coef", ["intercept", "slope"]),
          covers=("ML-01",))
def ols_one_feature_bars(spark, sf_dir):
    c = one_feature_coefs(bt(spark, sf_dir))
    return c.select("symbol", "n", "intercept", F.col("coef")[0].alias("slope"))


@register("ml05_linear_scoring_bars",
          rounded(f"""WITH {COEF_SQL}
SELECT bt.symbol, bt.ts, bt.seq, bt.target AS actual, coef.intercept + coef.slope * bt.ret AS pred
FROM bt JOIN coef ON bt.symbol = coef.symbol WHERE bt.split = 'test'""", ["actual", "pred"]),
          covers=("ML-05", "JN-04"))
def linear_scoring_bars(spark, sf_dir):
    t = bt(spark, sf_dir)
    s = linear.score_linear(t.filter(F.col("split") == "test"), one_feature_coefs(t), ONE)
    return s.select("symbol", "ts", "seq", F.col("target").alias("actual"), "pred")


@register("ml13_price_forecast_bars",
          rounded(f"""WITH {COEF_SQL},
p AS (SELECT bt.symbol, bt.ts, bt.close, coef.intercept + coef.slope * bt.ret AS pred
      FROM bt JOIN coef ON bt.symbol = coef.symbol WHERE bt.split = 'test')
SELECT symbol, ts, close, pred, round(close * (1 + pred), 4) AS pred_price, round(pred * 100, 4) AS change_pct
FROM p""", ["close", "pred", "pred_price", "change_pct"]),
          covers=("ML-13",))
def price_forecast_bars(spark, sf_dir):
    t = bt(spark, sf_dir)
    s = linear.score_linear(t.filter(F.col("split") == "test"), one_feature_coefs(t), ONE)
    return linear.price_forecast(s.select("symbol", "ts", "close", "pred"))


def _horizon_sql() -> str:
    parts = []
    for h in (1, 5, 10):
        parts.append(f"SELECT symbol, ts, seq, split, close, ret, {h} AS h, "
                     f"lead(close, {h}) OVER (PARTITION BY symbol, split ORDER BY ts, seq) / close - 1 AS target_h "
                     f"FROM bt")
    union = "\nUNION ALL ".join(parts)
    return f"""WITH {BAR_TRAIN_SQL},
hz AS ({union}),
hc AS (SELECT symbol, h, regr_intercept(target_h, ret) AS b0, regr_slope(target_h, ret) AS b1 FROM hz
       WHERE split = 'train' AND target_h IS NOT NULL GROUP BY symbol, h),
hp AS (SELECT hz.*, hc.b0 + hc.b1 * hz.ret AS pred FROM hz JOIN hc ON hz.symbol = hc.symbol AND hz.h = hc.h
       WHERE hz.split = 'test' AND hz.target_h IS NOT NULL)
SELECT symbol, CAST(h AS BIGINT) AS h, count(*) AS n, sqrt(avg(pow(target_h - pred, 2))) AS rmse,
       avg(CASE WHEN sign(target_h) = sign(pred) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       avg(abs(close * (1 + target_h) - close * (1 + pred))) AS price_mae
FROM hp GROUP BY symbol, h"""


@register("ml07_multi_horizon_bars", rounded(_horizon_sql(), ["rmse", "directional_accuracy", "price_mae"]),
          covers=("ML-07", "WN-14"))
def multi_horizon_bars(spark, sf_dir):
    hz = linear.horizon_frame(bt(spark, sf_dir), (1, 5, 10)).filter(F.col("target_h").isNotNull())
    coefs = linear.fit_linear(hz.filter(F.col("split") == "train"), ONE, "target_h", ["symbol", "h"])
    p = linear.score_linear(hz.filter(F.col("split") == "test"), coefs, ONE, ["symbol", "h"])
    a, pr = F.col("target_h"), F.col("pred")
    return p.groupBy("symbol", "h").agg(
        F.count(F.lit(1)).alias("n"), M.rmse(a, pr).alias("rmse"), M.directional_accuracy(a, pr).alias(
            "directional_accuracy"),
        F.avg(F.abs(F.col("close") * (1 + a) - F.col("close") * (1 + pr))).alias("price_mae"))


NEXT_SQL = f"""{BAR_TRAIN_SQL},
lim AS (SELECT symbol, min(ret) AS lo, max(ret) AS hi FROM bt WHERE split = 'train' GROUP BY symbol),
s1 AS (SELECT bt.*, (bt.ret - lim.lo) / CASE WHEN lim.hi = lim.lo THEN 1.0 ELSE lim.hi - lim.lo END AS ret_s
       FROM bt JOIN lim ON bt.symbol = lim.symbol),
cs AS (SELECT symbol, regr_intercept(target, ret_s) AS b0, regr_slope(target, ret_s) AS b1 FROM s1
       WHERE split = 'train' GROUP BY symbol),
sv AS (SELECT symbol, arg_max(ts, (ts, seq)) AS ts, arg_max(close, (ts, seq)) AS close, arg_max(ret, (ts, seq)) AS ret
       FROM bf WHERE ret IS NOT NULL GROUP BY symbol),
pr AS (SELECT sv.symbol, sv.ts, sv.close,
              cs.b0 + cs.b1 * (sv.ret - lim.lo) / CASE WHEN lim.hi = lim.lo THEN 1.0 ELSE lim.hi - lim.lo END AS pred
       FROM sv JOIN lim ON sv.symbol = lim.symbol JOIN cs ON sv.symbol = cs.symbol)"""


@register("ml14_next_step_forecast_bars",
          rounded(f"""WITH {NEXT_SQL}
SELECT symbol, ts, close, pred, round(close * (1 + pred), 4) AS pred_price, round(pred * 100, 4) AS change_pct
FROM pr""", ["close", "pred", "pred_price", "change_pct"]),
          covers=("ML-14", "SL-04", "FS-02", "ML-05", "ML-13", "PF-08"))
def next_step_forecast_bars(spark, sf_dir):
    t = bt(spark, sf_dir)
    scaler = scale.fit_minmax(t, ONE)
    scaled = scale.transform_minmax(t, ONE, scaler=scaler)
    coefs = linear.fit_linear(scaled.filter(F.col("split") == "train"), ONE, "target", ["symbol"])
    serving = train.bar_features(spark, sf_dir)
    return forecast.next_step(serving, ONE, coefs, scaler)


@register("ml15_backtest_bars",
          rounded(f"""WITH {COEF_SQL},
sv AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS cnt FROM bf WHERE ret IS NOT NULL) WHERE cnt >= 70),
tl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn FROM sv)
       WHERE rn <= 60),
sc AS (SELECT tl.symbol, tl.ts, tl.seq, tl.close, tl.target AS actual, coef.intercept + coef.slope * tl.ret AS pred
       FROM tl JOIN coef ON tl.symbol = coef.symbol),
pp AS (SELECT *, coalesce(lag(close, 1) OVER ({W}) * (1 + pred), close) AS pred_price FROM sc),
met AS (SELECT symbol, count(*) AS n, sqrt(avg(pow(actual - pred, 2))) AS rmse, avg(abs(actual - pred)) AS mae,
               avg(CASE WHEN sign(actual) = sign(pred) THEN 1.0 ELSE 0.0 END) AS directional_accuracy
        FROM pp WHERE actual IS NOT NULL AND pred IS NOT NULL GROUP BY symbol),
pe AS (SELECT symbol, avg(abs(close - pred_price)) AS price_mae, avg(abs(close - pred_price)) * 10000 AS mae_pips
       FROM pp GROUP BY symbol)
SELECT met.*, pe.price_mae, pe.mae_pips FROM met LEFT JOIN pe ON met.symbol = pe.symbol""",
                  ["rmse", "mae", "directional_accuracy", "price_mae", "mae_pips"]),
          covers=("ML-15", "SL-03", "WN-17", "AG-16", "AU-10"))
def backtest_bars(spark, sf_dir):
    coefs = one_feature_coefs(bt(spark, sf_dir))
    return forecast.backtest(train.bar_features(spark, sf_dir), ONE, coefs)["metrics"]


SEQ_T = 5


@register("ml16_sequence_scoring_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, ts, seq, split,
       CASE WHEN count(*) OVER (PARTITION BY symbol, split ORDER BY ts, seq ROWS BETWEEN {SEQ_T - 1} PRECEDING AND CURRENT ROW)
                 = {SEQ_T}
            THEN avg(ret) OVER (PARTITION BY symbol, split ORDER BY ts, seq ROWS BETWEEN {SEQ_T - 1} PRECEDING AND CURRENT ROW)
            ELSE 0.0 END AS pred
FROM bt""", ["pred"]),
          covers=("ML-16", "WN-15"))
def sequence_scoring_bars(spark, sf_dir):
    w = wn.sequences(bt(spark, sf_dir), ["ret", "rsi_14", "range_pct"], SEQ_T, keep_incomplete=True)
    model = forecast.batch_to_pandas_model([1.0] * SEQ_T)
    s = forecast.score_sequences(w.select("symbol", "ts", "seq", "split", "window"), model)
    return s.drop("window")


@register("ml03_fold_blocks_bars",
          f"""WITH {BAR_TRAIN_SQL},
fb AS (SELECT *, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM bt
       WHERE split = 'train'),
fb2 AS (SELECT *, floor(n / 6) AS t FROM fb)
SELECT symbol, CAST(CASE WHEN pos < n - 5 * t THEN 0 ELSE 1 + floor((pos - (n - 5 * t)) / t) END AS BIGINT) AS block,
       CAST(count(*) AS BIGINT) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM fb2 GROUP BY 1, 2""",
          covers=("ML-03",))
def fold_blocks_bars(spark, sf_dir):
    f = linear.fold_blocks(bt(spark, sf_dir).filter(F.col("split") == "train"))
    return f.groupBy("symbol", "block").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"),
                                            F.max("ts").alias("last_ts"))


# ------------------------------------------------------------------ rows-only (numpy-checked in tests)
def scaled_bt(spark, sf_dir):
    return scale.transform_minmax(bt(spark, sf_dir), EXT)


@register("ml01_ols_extended_bars", covers=("ML-01",))
def ols_extended_bars(spark, sf_dir):
    s = scaled_bt(spark, sf_dir)
    c = linear.fit_linear(s.filter(F.col("split") == "train"), EXT, "target", ["symbol"])
    return linear.coefficients_long(c, EXT)


@register("ml02_ridge_extended_bars", covers=("ML-02",))
def ridge_extended_bars(spark, sf_dir):
    s = scaled_bt(spark, sf_dir)
    c = linear.fit_linear(s.filter(F.col("split") == "train"), EXT, "target", ["symbol"], alpha=1.0)
    return linear.coefficients_long(c, EXT)


@register("ml04_ridge_grid_bars", covers=("ML-04", "ML-03"))
def ridge_grid_bars(spark, sf_dir):
    s = scaled_bt(spark, sf_dir).filter(F.col("split") == "train")
    return linear.ridge_grid(s, EXT, "target")["best"]


@register("ml06_coefficient_importance_bars", covers=("ML-06", "SL-05"))
def coefficient_importance_bars(spark, sf_dir):
    s = scaled_bt(spark, sf_dir)
    c = linear.fit_linear(s.filter(F.col("split") == "train"), EXT, "target", ["symbol"], alpha=1.0)
    return linear.importance(c, EXT).filter(F.col("rank") <= 5)


ABLATIONS = {
    "all": EXT,
    "no_price": [f for f in EXT if f not in ("open", "high", "low", "close")],
    "indicators": ["ma_50", "range_pct", "atr_14", "vol_5d", "vol_20d", "vol_ratio"],
    "returns": ["ret", "ret_20d", "lag_1", "lag_2", "lag_3", "lag_5"],
}


@register("ml17_ablation_bars", covers=("ML-17", "PF-10"))
def ablation_bars(spark, sf_dir):
    s = scaled_bt(spark, sf_dir)
    return linear.evaluate_subsets(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"),
                                   ABLATIONS, EXT, "target", alpha=1.0)


@register("ml08_arma_order_bars", covers=("ML-08",))
def arma_order_bars(spark, sf_dir):
    o = arma.select_order(bt(spark, sf_dir), "ret")["orders"]
    return o.select("symbol", "p", "q", "aic")


@register("ml09_walk_forward_bars", covers=("ML-09",))
def walk_forward_bars(spark, sf_dir):
    wf = arma.walk_forward(bt(spark, sf_dir), "ret")
    a, p = F.col("actual"), F.col("pred")
    return wf.groupBy("symbol", "p", "q").agg(F.count(F.lit(1)).alias("n"), M.rmse(a, p).alias("rmse"),
                                              M.directional_accuracy(a, p).alias("directional_accuracy"))


@register("ml10_in_sample_tail_bars", covers=("ML-10", "JN-05"))
def in_sample_tail_bars(spark, sf_dir):
    t = bt(spark, sf_dir)
    return forecast.in_sample_last(t, ONE, one_feature_coefs(t), 30).select("symbol", "ts", "actual", "pred",
                                                                             "rn_desc")


@register("ag17_adf_daily", covers=("AG-17",))
def adf_daily(spark, sf_dir):
    from marketframe.sources import panels
    return arma.adf_test(panels.daily(spark, sf_dir), "close")


@register("ag17_adf_bars", covers=("AG-17",))
def adf_bars(spark, sf_dir):
    return arma.adf_test(bt(spark, sf_dir), "ret")


__all__ = ["rows"]


RETRAIN_CONFIGS = {
    "linearret": (ONE, 0.0),
    "linearext": (EXT, 0.0),
    "ridgeext": (EXT, 1.0),
    "arma": retrain.Arma(2, 1, 8),
}
ONE_FEATURE_CONFIGS = {"linearret": (ONE, 0.0), "linearrange": (["range_pct"], 0.0)}


@register("ml18_retrain_summary_bars", covers=("ML-18", "RG-12", "RG-13", "RG-06"))
def retrain_summary_bars(spark, sf_dir):
    """Scheduled retrain of the top aliased models with their stored configs."""
    s = scale.transform_minmax(bt(spark, sf_dir), [f for f in EXT if f != "ret"])
    return retrain.retrain(s, RETRAIN_CONFIGS)["summary"]


def _fit_sql(name: str, col: str) -> str:
    fit = f"regr_intercept(target, {col}) AS b0, regr_slope(target, {col}) AS b1 FROM bt"
    return f"""{name}0 AS (SELECT symbol, {fit} WHERE split = 'train' GROUP BY symbol),
{name}1 AS (SELECT symbol, {fit} GROUP BY symbol),
{name} AS (SELECT bt.symbol, bt.symbol || '_{name}' AS name, max(ts) AS start_time, sqrt(avg(pow(target - (o.b0 + o.b1 * {col}), 2))) AS old_rmse,
                  sqrt(avg(pow(target - (n.b0 + n.b1 * {col}), 2))) AS new_rmse
           FROM bt JOIN {name}0 o ON bt.symbol = o.symbol JOIN {name}1 n ON bt.symbol = n.symbol WHERE split = 'test' GROUP BY 1, 2)"""


@register("rg13_retrain_summary_one_feature_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
{_fit_sql('linearret', 'ret')},
{_fit_sql('linearrange', 'range_pct')}
SELECT symbol AS experiment, name, CAST(1 AS BIGINT) AS old_version, old_rmse, CAST(2 AS BIGINT) AS new_version, new_rmse, new_rmse - old_rmse AS rmse_change
FROM (SELECT * FROM linearret UNION ALL SELECT * FROM linearrange)""", ["old_rmse", "new_rmse", "rmse_change"]),
          covers=("ML-18", "RG-13", "RG-12", "RG-06"))
def retrain_summary_one_feature_bars(spark, sf_dir):
    """Both configs of a series are among its top aliases, so the summary has both, before and after."""
    return retrain.retrain(bt(spark, sf_dir), ONE_FEATURE_CONFIGS)["summary"]
