"""Registered queries: statistics, feature selection and audit flag tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.operators import audit, evaluate as ev, features as wn, linear, rows, selection, stats
from marketframe.plans import train
from marketframe.plans.q_bars import BAR_FEATURES_SQL, BAR_TRAIN_SQL, PRED_SQL, _FULL_SQL, bar_predictions
from marketframe.plans.registry import DAILY, TICKS, W, register, rounded
from marketframe.sources import panels
from marketframe.spec import DEFAULT_SPEC

EXT = wn.EXTENDED_FEATURES
ORD_VALUES = ", ".join(f"('{f}', {i}, {'true' if f in selection.MUST_KEEP else 'false'})" for i, f in enumerate(EXT))


def _corr_sql(a: str, b: str) -> str:
    return (f"CASE WHEN stddev_samp({a}) * stddev_samp({b}) > 0 "
            f"THEN covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})) END")


TARGET_CORR_SQL = f"""{BAR_TRAIN_SQL},
u AS (UNPIVOT (SELECT symbol, ts, target, {', '.join(EXT)} FROM bt WHERE split = 'train')
      ON {', '.join(EXT)} INTO NAME feature VALUE v),
tc AS (SELECT symbol, feature, {_corr_sql('v', 'target')} AS corr FROM u GROUP BY symbol, feature)"""

MATRIX_SQL = f"""{TARGET_CORR_SQL},
ordt AS (SELECT * FROM (VALUES {ORD_VALUES}) AS v(feature, ord, mk)),
uo AS (SELECT u.*, ordt.ord FROM u JOIN ordt USING (feature)),
cm AS (SELECT x.symbol, x.feature AS feature_a, y.feature AS feature_b, {_corr_sql('x.v', 'y.v')} AS corr
       FROM uo x JOIN uo y ON x.symbol = y.symbol AND x.ts = y.ts AND x.ord < y.ord
       GROUP BY x.symbol, x.feature, y.feature)"""


def train_bars(spark, sf_dir):
    return train.bar_training_frame(spark, sf_dir).filter(F.col("split") == "train")


def target_corr_bars(spark, sf_dir):
    return stats.target_correlation(train_bars(spark, sf_dir), EXT, "target", ["symbol"])


def corr_matrix_bars(spark, sf_dir):
    # the training frame has no NULLs (incomplete rows were dropped): Gram fast path
    return stats.correlation_matrix(train_bars(spark, sf_dir), EXT, ["symbol"], complete=True)


@register("ag01_series_summary_ticks",
          rounded(f"""WITH {TICKS}
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, min(ts) AS first_ts, max(ts) AS last_ts, min(close) AS min_price,
       max(close) AS max_price, arg_max(close, (ts, seq)) AS current_price FROM ticks GROUP BY symbol""",
                  ["min_price", "max_price", "current_price"]),
          covers=("AG-01",))
def series_summary_ticks(spark, sf_dir):
    return stats.series_summary(panels.ticks(spark, sf_dir))


@register("ag01_series_summary_daily",
          rounded(f"""WITH {DAILY}
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, min(ts) AS first_ts, max(ts) AS last_ts, min(close) AS min_price,
       max(close) AS max_price, arg_max(close, (ts, seq)) AS current_price FROM daily GROUP BY symbol""",
                  ["min_price", "max_price", "current_price"]),
          covers=("AG-01",))
def series_summary_daily(spark, sf_dir):
    return stats.series_summary(panels.daily(spark, sf_dir))


_NULL_COLS = ["ret", "ma_50", "rsi_14", "atr_14", "vol_20d", "target"]


@register("ag02_null_counts_bars",
          f"""WITH {BAR_FEATURES_SQL},
w AS (SELECT symbol, {', '.join(f'CAST(count_if({c} IS NULL) AS BIGINT) AS {c}' for c in _NULL_COLS)} FROM bf
      GROUP BY symbol),
w2 AS (SELECT *, {' + '.join(_NULL_COLS)} AS __total__ FROM w)
UNPIVOT w2 ON {', '.join(_NULL_COLS)}, __total__ INTO NAME "column" VALUE nulls""",
          covers=("AG-02",))
def null_counts_bars(spark, sf_dir):
    return stats.null_counts(train.bar_features(spark, sf_dir), _NULL_COLS, ["symbol"])


@register("ag03_target_correlation_bars",
          rounded(f"""WITH {TARGET_CORR_SQL}
SELECT symbol, feature, corr, abs(corr) AS abs_corr,
       CAST(row_number() OVER (PARTITION BY symbol ORDER BY abs(corr) DESC NULLS LAST, feature) AS BIGINT) AS rank
FROM tc""", ["corr", "abs_corr"]),
          covers=("AG-03", "SL-05"))
def target_correlation_bars(spark, sf_dir):
    return target_corr_bars(spark, sf_dir)


@register("sl05_top5_abs_corr_bars",
          rounded(f"""WITH {TARGET_CORR_SQL}
SELECT symbol, feature, corr FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY abs(corr) DESC, feature) AS rn FROM tc) WHERE rn <= 5""",
                  ["corr"]),
          covers=("SL-05",))
def top5_abs_corr_bars(spark, sf_dir):
    t = target_corr_bars(spark, sf_dir).select("symbol", "feature", "corr")
    return rows.top_k_abs(t, "corr", 5, by=["symbol"])


@register("ag04_correlation_matrix_bars",
          rounded(f"WITH {MATRIX_SQL}\nSELECT * FROM cm", ["corr"]),
          covers=("AG-04",))
def correlation_matrix_bars(spark, sf_dir):
    return corr_matrix_bars(spark, sf_dir)


ACF_LAGS = 10


def _acf_sql() -> str:
    lags = ", ".join(f"lag(d, {k}) OVER ({W}) AS l{k}" for k in range(1, ACF_LAGS + 1))
    aggs = ", ".join(f"coalesce(sum(d * l{k}), 0) / nullif(sum(d * d), 0) AS \"{k}\"" for k in range(1, ACF_LAGS + 1))
    cols = ", ".join(f'"{k}"' for k in range(1, ACF_LAGS + 1))
    return f"""WITH {BAR_TRAIN_SQL},
dd AS (SELECT symbol, ts, seq, ret - avg(ret) OVER (PARTITION BY symbol) AS d FROM bt WHERE split = 'train'),
ll AS (SELECT *, {lags} FROM dd),
w AS (SELECT symbol, {aggs} FROM ll GROUP BY symbol),
u AS (UNPIVOT w ON {cols} INTO NAME lag VALUE acf)
SELECT symbol, CAST(lag AS BIGINT) AS lag, acf, abs(acf) > 0.05 AS significant FROM u"""


def acf_bars(spark, sf_dir):
    return stats.autocorrelation(train_bars(spark, sf_dir), "ret", ACF_LAGS)


@register("ag05_autocorrelation_bars", rounded(_acf_sql(), ["acf"]), covers=("AG-05",))
def autocorrelation_bars(spark, sf_dir):
    return acf_bars(spark, sf_dir)


@register("ag06_partial_autocorrelation_bars", covers=("AG-06",))
def partial_autocorrelation_bars(spark, sf_dir):
    """PACF by Durbin-Levinson on each series' ACF vector (numpy-checked in tests)."""
    return stats.partial_autocorrelation(acf_bars(spark, sf_dir))


@register("ag07_return_histogram_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
b AS (SELECT symbol, ret, min(ret) OVER (PARTITION BY symbol) AS lo0, max(ret) OVER (PARTITION BY symbol) AS hi0 FROM bt),
c AS (SELECT *, CASE WHEN hi0 = lo0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN hi0 = lo0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM b),
d AS (SELECT symbol, lo, (hi - lo) / 100.0 AS w,
             CAST(least(floor((ret - lo) / ((hi - lo) / 100.0)), 99) AS BIGINT) AS bin FROM c)
SELECT symbol, bin, any_value(lo) + bin * any_value(w) AS bin_lo, any_value(lo) + (bin + 1) * any_value(w) AS bin_hi,
       count(*) AS n FROM d GROUP BY symbol, bin""", ["bin_lo", "bin_hi"]),
          covers=("AG-07",))
def return_histogram_bars(spark, sf_dir):
    return stats.histogram(train.bar_training_frame(spark, sf_dir), "ret", 100, ["symbol"])


_DESC = ["close", "ret", "vol_20d"]


def _describe_sql() -> str:
    parts = []
    for c in _DESC:
        parts.append(f"""SELECT symbol, '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM bt GROUP BY symbol""")
    return f"WITH {BAR_TRAIN_SQL}\n" + "\nUNION ALL\n".join(parts)


@register("ag08_describe_bars", rounded(_describe_sql(), ["mean", "std", "min", "p25", "p50", "p75", "max"]),
          covers=("AG-08",))
def describe_bars(spark, sf_dir):
    return stats.describe(train.bar_training_frame(spark, sf_dir), _DESC, ["symbol"])


@register("au01_correlation_flags_bars",
          rounded(f"""WITH {TARGET_CORR_SQL}
SELECT symbol, feature, corr, corr > 0.95 AS leak_signed, abs(corr) > 0.7 AS leak_abs,
       abs(corr) > 0.5 AS leak_abs_test, abs(corr) > 0.05 AS meaningful FROM tc""", ["corr"]),
          covers=("AU-01",))
def correlation_flags_bars(spark, sf_dir):
    t = target_corr_bars(spark, sf_dir).select("symbol", "feature", "corr")
    return audit.correlation_flags(t)


@register("au01_low_signal_summary_bars",
          f"""WITH {TARGET_CORR_SQL}
SELECT symbol, count(*) AS features, CAST(count_if(abs(corr) > 0.05) AS BIGINT) AS meaningful, CAST(count_if(corr > 0.95) AS BIGINT) AS leak_signed,
       CAST(count_if(abs(corr) > 0.7) AS BIGINT) AS leak_abs, CAST(count_if(abs(corr) > 0.05) AS BIGINT) < 5 AS too_few_meaningful
FROM tc GROUP BY symbol""",
          covers=("AU-01",))
def low_signal_summary_bars(spark, sf_dir):
    t = target_corr_bars(spark, sf_dir).select("symbol", "feature", "corr")
    return audit.low_signal_summary(audit.correlation_flags(t), ["symbol"])


SPLIT_METRICS_SQL = f"""{PRED_SQL},
ms AS (SELECT symbol, model, split, {_FULL_SQL}
       FROM preds WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY symbol, model, split)"""


def split_metrics(spark, sf_dir):
    from marketframe.functions import metrics as M
    return ev.evaluate(bar_predictions(spark, sf_dir), ["symbol", "model", "split"], metrics=M.FULL)


@register("au03_too_good_flags_bars",
          rounded(f"""WITH {SPLIT_METRICS_SQL},
dg AS (SELECT symbol, model, stddev_pop(pred) / nullif(stddev_samp(actual), 0) AS std_ratio,
              {_corr_sql('pred', 'ret')} AS corr_today
       FROM preds WHERE split = 'test' AND pred IS NOT NULL AND actual IS NOT NULL GROUP BY symbol, model)
SELECT ms.symbol, ms.model, ms.directional_accuracy, ms.sharpe_ratio, dg.std_ratio, dg.corr_today,
       ms.directional_accuracy > 0.65 AS da_suspicious, ms.sharpe_ratio > 3.0 AS sharpe_suspicious,
       dg.corr_today > 0.5 AS predicts_today, dg.std_ratio > 0.8 AS volatility_suspicious
FROM ms JOIN dg ON ms.symbol = dg.symbol AND ms.model = dg.model WHERE ms.split = 'test'""",
                  ["directional_accuracy", "sharpe_ratio", "std_ratio", "corr_today"]),
          covers=("AU-03",))
def too_good_flags_bars(spark, sf_dir):
    p = bar_predictions(spark, sf_dir)
    m = split_metrics(spark, sf_dir).filter(F.col("split") == "test").select(
        "symbol", "model", "directional_accuracy", "sharpe_ratio")
    d = ev.prediction_diagnostics(p.filter(F.col("split") == "test"), ["symbol", "model"])
    return audit.too_good_flags(m.join(d, ["symbol", "model"]))


@register("au04_da_gap_bars",
          rounded(f"""WITH {SPLIT_METRICS_SQL},
w AS (SELECT symbol, model, max(CASE WHEN split = 'train' THEN directional_accuracy END) AS train_directional_accuracy,
             max(CASE WHEN split = 'test' THEN directional_accuracy END) AS test_directional_accuracy
      FROM ms GROUP BY symbol, model)
SELECT *, train_directional_accuracy - test_directional_accuracy AS da_gap,
       CASE WHEN train_directional_accuracy - test_directional_accuracy < -0.05 THEN 'test_better'
            WHEN train_directional_accuracy - test_directional_accuracy > 0.10 THEN 'possible_overfitting'
            WHEN train_directional_accuracy - test_directional_accuracy IS NOT NULL THEN 'similar' END AS da_gap_class
FROM w""", ["train_directional_accuracy", "test_directional_accuracy", "da_gap"]),
          covers=("AU-04",))
def da_gap_bars(spark, sf_dir):
    return audit.da_gap(split_metrics(spark, sf_dir), ["symbol", "model"])


@register("au05_overfitting_bars",
          rounded(f"""WITH {SPLIT_METRICS_SQL},
w AS (SELECT symbol, model,
             max(CASE WHEN split = 'train' THEN rmse END) AS train_rmse, max(CASE WHEN split = 'test' THEN rmse END) AS test_rmse,
             max(CASE WHEN split = 'train' THEN mae END) AS train_mae, max(CASE WHEN split = 'test' THEN mae END) AS test_mae,
             max(CASE WHEN split = 'train' THEN r2 END) AS train_r2, max(CASE WHEN split = 'test' THEN r2 END) AS test_r2
      FROM ms GROUP BY symbol, model),
x AS (SELECT *, train_r2 - test_r2 AS r2_gap, CASE WHEN train_mae > 0 THEN test_mae / train_mae END AS mae_ratio,
             CASE WHEN train_rmse > 0 THEN test_rmse / train_rmse END AS rmse_ratio FROM w)
SELECT *, CASE WHEN train_rmse IS NULL OR test_rmse IS NULL THEN 'UNKNOWN'
               WHEN r2_gap < 0.05 AND mae_ratio > 0.9 AND mae_ratio < 1.1 THEN 'GOOD'
               WHEN r2_gap < 0.1 THEN 'MILD' ELSE 'SEVERE' END AS diagnosis,
       r2_gap > 0.1 AS r2_gap_warning FROM x""",
                  ["train_rmse", "test_rmse", "train_mae", "test_mae", "train_r2", "test_r2", "r2_gap", "mae_ratio",
                   "rmse_ratio"]),
          covers=("AU-05",))
def overfitting_bars(spark, sf_dir):
    return audit.overfitting(split_metrics(spark, sf_dir), ["symbol", "model"])


@register("au06_consistency_bars",
          rounded(f"""WITH {SPLIT_METRICS_SQL},
g AS (SELECT symbol, count(*) AS models, CAST(count_if(directional_accuracy > 0.52 AND r2 > 0) AS BIGINT) AS good_models,
             max(CASE WHEN model = 'ma5' THEN directional_accuracy END) AS focus_da
      FROM ms WHERE split = 'test' GROUP BY symbol)
SELECT *, good_models = 1 AND focus_da > 0.65 AS only_focus_good, good_models >= 2 AS multiple_good,
       CASE WHEN focus_da > 0.70 THEN 'suspicious' WHEN focus_da > 0.60 THEN 'good' ELSE 'realistic' END AS tier
FROM g""", ["focus_da"]),
          covers=("AU-06",))
def consistency_bars(spark, sf_dir):
    m = split_metrics(spark, sf_dir).filter(F.col("split") == "test")
    return audit.consistency(m, ["symbol"], "ma5")


@register("au07_return_recomputation_bars",
          f"""WITH {BAR_TRAIN_SQL},
r AS (SELECT symbol, ret, target, close / nullif(lag(close, 1) OVER ({W}), 0) - 1 AS rc,
             lead(ret, 1) OVER ({W}) AS nx FROM bt)
SELECT symbol, count(*) AS rows, CAST(count_if(abs(ret - rc) > 1e-9) AS BIGINT) AS return_mismatches,
       CAST(count_if(abs(target - nx) > 1e-9) AS BIGINT) AS target_mismatches FROM r GROUP BY symbol""",
          covers=("AU-07",))
def return_recomputation_bars(spark, sf_dir):
    return audit.return_recomputation(train.bar_training_frame(spark, sf_dir))


@register("au10_history_gate_ticks",
          f"""WITH {TICKS}
SELECT symbol, count(*) AS rows, count(*) >= 70 AS backtest_ok, count(*) >= 250 AS training_ok
FROM ticks GROUP BY symbol""",
          covers=("AU-10",))
def history_gate_ticks(spark, sf_dir):
    return audit.history_gate(panels.ticks(spark, sf_dir))


SELECTION_SQL = f"""{MATRIX_SQL},
cand AS (SELECT tc.symbol, tc.feature, ordt.ord, ordt.mk, abs(tc.corr) AS s FROM tc JOIN ordt USING (feature)
         WHERE ordt.mk OR abs(tc.corr) > 0.03),
pairs AS (SELECT a.symbol, a.feature AS fa, b.feature AS fb, a.mk AS mka, b.mk AS mkb, a.s AS sa, b.s AS sb,
                 abs(cm.corr) AS pc
          FROM cm JOIN cand a ON cm.symbol = a.symbol AND cm.feature_a = a.feature
                  JOIN cand b ON cm.symbol = b.symbol AND cm.feature_b = b.feature),
dropped AS (SELECT DISTINCT symbol, CASE WHEN sa < sb THEN fa ELSE fb END AS feature FROM pairs
            WHERE NOT (mka AND mkb) AND pc > 0.95 AND NOT (CASE WHEN sa < sb THEN mka ELSE mkb END))"""


@register("fs04_candidates_bars",
          rounded(f"""WITH {SELECTION_SQL}
SELECT symbol, feature, CAST(ord AS BIGINT) AS ord, mk AS must_keep, s AS abs_corr FROM cand""", ["abs_corr"]),
          covers=("FS-04",))
def candidates_bars(spark, sf_dir):
    return selection.candidates(target_corr_bars(spark, sf_dir), EXT, ["symbol"])


@register("fs05_redundancy_prune_bars",
          rounded(f"""WITH {SELECTION_SQL}
SELECT symbol, feature, CAST(ord AS BIGINT) AS ord, mk AS must_keep, s AS abs_corr FROM cand
WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.symbol = cand.symbol AND d.feature = cand.feature)""", ["abs_corr"]),
          covers=("FS-05",))
def redundancy_prune_bars(spark, sf_dir):
    return selection.pruned(linear.gram(train_bars(spark, sf_dir), EXT, "target", ["symbol"]), EXT, ["symbol"])


@register("fs06_greedy_prune_bars", covers=("FS-06",))
def greedy_prune_bars(spark, sf_dir):
    """Order-dependent greedy prune per series (pandas oracle in tests)."""
    return selection.greedy_prune(corr_matrix_bars(spark, sf_dir), target_corr_bars(spark, sf_dir), EXT, ["symbol"])
