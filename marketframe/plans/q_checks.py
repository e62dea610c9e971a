"""Registered queries with SQL twins for operators that the wide queries run without one: closed
forms (one- and two-regressor fits, lag-0 unit-root test), readers, profiles and schema audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.operators import arma, audit, clean, evaluate as ev, forecast, linear, rows, selection, stats
from marketframe.plans import train
from marketframe.plans.q_bars import BAR_FEATURES_SQL, BAR_TRAIN_SQL
from marketframe.plans.q_io import CATALOG_SQL, HALF_YEAR_START, daily_dates, write_history_files
from marketframe.plans.q_models import COEF_SQL, EXT, ONE, bt, one_feature_coefs
from marketframe.plans.registry import DAILY, W, register, rounded
from marketframe.session import checkpoint, scratch_dir
from marketframe.sources import files, panels

TAIL = 30
CORR = ["ret", "ma_50", "rsi_14", "vol_20d"]


@register("ml01_ols_pooled_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT count(*) AS n, regr_intercept(target, ret) AS intercept, regr_slope(target, ret) AS slope FROM bt WHERE split = 'train'""",
                  ["intercept", "slope"]), covers=("ML-01",))
def ols_pooled_bars(spark, sf_dir):
    """One fit over all series: the Gram without keys."""
    c = linear.fit_linear(bt(spark, sf_dir).filter(F.col("split") == "train"), ONE, "target", by=())
    return c.select("n", "intercept", F.col("coef")[0].alias("slope"))


TWO_SQL = f"""{BAR_TRAIN_SQL},
m AS (SELECT symbol, count(*) AS n, avg(ret) AS ma, avg(rsi_14) AS mb, avg(target) AS my,
             var_pop(ret) * count(*) + ALPHA AS aa, var_pop(rsi_14) * count(*) + ALPHA AS bb, covar_pop(ret, rsi_14) * count(*) AS ab,
             covar_pop(ret, target) * count(*) AS ay, covar_pop(rsi_14, target) * count(*) AS byy
      FROM bt WHERE split = 'train' GROUP BY symbol),
c AS (SELECT *, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS coef_ret, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS coef_rsi FROM m)"""


@register("ml02_ridge_two_features_bars",
          rounded(f"""WITH {TWO_SQL.replace('ALPHA', '1.0')}
SELECT symbol, n, my - coef_ret * ma - coef_rsi * mb AS intercept, coef_ret, coef_rsi FROM c""", ["intercept", "coef_ret", "coef_rsi"]),
          covers=("ML-02",))
def ridge_two_features_bars(spark, sf_dir):
    """Ridge with two regressors: Cramer's rule on the penalised normal equations."""
    c = linear.fit_linear(bt(spark, sf_dir).filter(F.col("split") == "train"), ["ret", "rsi_14"], "target", alpha=1.0)
    return c.select("symbol", "n", "intercept", F.col("coef")[0].alias("coef_ret"), F.col("coef")[1].alias("coef_rsi"))


@register("ml06_importance_two_features_bars",
          rounded(f"""WITH {TWO_SQL.replace('ALPHA', '0.0')},
l AS (SELECT symbol, 'ret' AS feature, coef_ret AS coefficient FROM c UNION ALL SELECT symbol, 'rsi_14', coef_rsi FROM c)
SELECT symbol, feature, coefficient, abs(coefficient) AS abs_coefficient,
       row_number() OVER (PARTITION BY symbol ORDER BY abs(coefficient) DESC, feature) AS rank,
       CASE WHEN coefficient > 0 THEN 'positive' ELSE 'negative' END AS direction FROM l""", ["coefficient", "abs_coefficient"]),
          covers=("ML-06",))
def importance_two_features_bars(spark, sf_dir):
    feats = ["ret", "rsi_14"]
    return linear.importance(linear.fit_linear(bt(spark, sf_dir).filter(F.col("split") == "train"), feats, "target"), feats)


@register("ml04_ridge_grid_one_feature_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
p AS (SELECT *, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM bt),
b AS (SELECT *, CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE 1 + (pos - (n - 5 * (n // 6))) // (n // 6) END AS block FROM p),
f AS (SELECT symbol, fold, alpha, avg(target) AS my, avg(ret) AS mx, covar_pop(ret, target) * count(*) / (var_pop(ret) * count(*) + alpha) AS slope
      FROM b, (SELECT unnest(range(1, 6)) AS fold), (SELECT unnest([0.001, 0.01, 0.1, 1.0, 10.0, 100.0]::DOUBLE[]) AS alpha)
      WHERE block < fold GROUP BY symbol, fold, alpha)
SELECT f.symbol, f.fold, f.alpha, avg(pow(b.target - f.my - f.slope * (b.ret - f.mx), 2)) AS mse
FROM f JOIN b ON b.symbol = f.symbol AND b.block = f.fold GROUP BY f.symbol, f.fold, f.alpha""", ["alpha", "mse"]),
          covers=("ML-03", "ML-04"))
def ridge_grid_one_feature_bars(spark, sf_dir):
    """All folds and penalties of the time-series grid, with one regressor."""
    return linear.ridge_grid(bt(spark, sf_dir), ONE, "target")["scores"]


@register("ml17_ablation_one_feature_bars",
          rounded("WITH " + BAR_TRAIN_SQL + "".join(f""",
c{i} AS (SELECT symbol, regr_intercept(target, {f}) AS b0, regr_slope(target, {f}) AS b1 FROM bt WHERE split = 'train' GROUP BY symbol)""" for i, f in enumerate(CORR)) + "\n"
                  + "\nUNION ALL ".join(f"""SELECT bt.symbol, '{f}' AS subset, CAST(1 AS BIGINT) AS n_features, avg(pow(target - b0 - b1 * {f}, 2)) AS mse,
       sqrt(avg(pow(target - b0 - b1 * {f}, 2))) AS rmse FROM bt JOIN c{i} ON bt.symbol = c{i}.symbol WHERE split = 'test' GROUP BY bt.symbol""" for i, f in enumerate(CORR)),
                  ["mse", "rmse"]), covers=("ML-17",))
def ablation_one_feature_bars(spark, sf_dir):
    """Every single-feature subset from one shared Gram."""
    t = bt(spark, sf_dir)
    return linear.evaluate_subsets(t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test"), {f: [f] for f in CORR}, CORR, "target")


@register("ag04_correlation_global_bars",
          rounded(f"WITH {BAR_TRAIN_SQL}\n" + "\nUNION ALL ".join(
              f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM bt" for i, a in enumerate(CORR) for b in CORR[i + 1:]), ["corr"]),
          covers=("AG-04",))
def correlation_global_bars(spark, sf_dir):
    return stats.correlation_matrix(bt(spark, sf_dir), CORR, (), complete=True)


@register("ag17_adf_lag0_daily",
          rounded(f"""WITH {DAILY},
d AS (SELECT symbol, close - lag(close) OVER ({W}) AS dy, lag(close) OVER ({W}) AS y1 FROM daily),
g AS (SELECT symbol, count(*) AS n, regr_sxx(dy, y1) AS sxx, regr_sxy(dy, y1) AS sxy, regr_syy(dy, y1) AS syy
      FROM d WHERE dy IS NOT NULL GROUP BY symbol),
t AS (SELECT symbol, n, (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS adf_stat FROM g)
SELECT symbol, n AS nobs, CAST(0 AS BIGINT) AS used_lag, adf_stat,
       -2.86154 - 2.8903 / n - 4.234 / pow(n, 2) - 40.04 / pow(n, 3) AS crit_5,
       adf_stat < -2.86154 - 2.8903 / n - 4.234 / pow(n, 2) - 40.04 / pow(n, 3) AS stationary FROM t""", ["adf_stat", "crit_5"]),
          covers=("AG-17",))
def adf_lag0_daily(spark, sf_dir):
    r = arma.adf_test(panels.daily(spark, sf_dir), "close", maxlag=0)
    return r.select("symbol", "nobs", "used_lag", "adf_stat", "crit_5", "stationary")


@register("ml10_in_sample_tail_one_feature_bars",
          rounded(f"""WITH {COEF_SQL},
p AS (SELECT bt.symbol, intercept + slope * ret AS pred, row_number() OVER (PARTITION BY bt.symbol ORDER BY ts DESC, seq DESC) AS rn
      FROM bt JOIN coef ON bt.symbol = coef.symbol WHERE split = 'train'),
a AS (SELECT symbol, ts, target AS actual, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS rn FROM bt WHERE split = 'test')
SELECT a.symbol, a.ts, a.actual, coalesce(p.pred, 0.0) AS pred, a.rn AS rn_desc
FROM a LEFT JOIN p ON a.symbol = p.symbol AND a.rn = p.rn AND p.rn <= {TAIL} WHERE a.rn <= {TAIL}""", ["actual", "pred"]),
          covers=("ML-10", "JN-05"))
def in_sample_tail_one_feature_bars(spark, sf_dir):
    t = bt(spark, sf_dir)
    return forecast.in_sample_last(t, ONE, one_feature_coefs(t), TAIL).select("symbol", "ts", "actual", "pred", "rn_desc")


@register("ml12_zero_baseline_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, count(*) AS n, sqrt(avg(pow(target, 2))) AS rmse, avg(abs(target)) AS mae FROM bt WHERE split = 'test' GROUP BY symbol""",
                  ["rmse", "mae"]), covers=("ML-12",))
def zero_baseline_bars(spark, sf_dir):
    z = forecast.zero_prediction(bt(spark, sf_dir).filter(F.col("split") == "test"))
    return ev.evaluate(z, ["symbol"]).select("symbol", "n", "rmse", "mae")


@register("sl08_labelled_rows_bars",
          rounded(f"""WITH {BAR_FEATURES_SQL}
SELECT symbol, ts, seq, target FROM bf WHERE target IS NOT NULL AND ma_50 IS NOT NULL""", ["target"]), covers=("SL-08",))
def labelled_rows_bars(spark, sf_dir):
    return rows.drop_null_target(train.bar_features(spark, sf_dir), "target", ["ma_50"]).select("symbol", "ts", "seq", "target")


@register("io01_csv_read_daily",
          rounded(f"WITH {DAILY}\nSELECT symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS Date, close AS Close FROM daily", ["Close"]),
          covers=("IO-01",))
def csv_read_daily(spark, sf_dir):
    """Files of one layout, read with an explicit schema."""
    root = scratch_dir(spark, "csv")
    daily_dates(spark, sf_dir).select("symbol", "Date", "Close").write.partitionBy("symbol").option("header", True).csv(root)
    schema = files.OHLCV_SCHEMA.__class__([f for f in files.OHLCV_SCHEMA if f.name in ("Date", "Close")])
    r = files.read_csv(spark, root, schema)
    return r.select(F.regexp_extract("_file", r"symbol=([^/]+)", 1).alias("symbol"), "Date", "Close")


@register("io11_metadata_sidecar_bars",
          f"""WITH {BAR_TRAIN_SQL}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(split = 'train') AS BIGINT) AS train_rows, CAST(count_if(split = 'test') AS BIGINT) AS test_rows,
       strftime(min(ts), '%Y-%m-%d %H') AS first_hour, strftime(max(ts), '%Y-%m-%d %H') AS last_hour, '{','.join(EXT)}' AS features FROM bt""",
          covers=("IO-11",))
def metadata_sidecar_bars(spark, sf_dir):
    """The sidecar as it is read back from its file."""
    path = f"{scratch_dir(spark, 'sidecar')}/metadata"
    files.metadata_sidecar(bt(spark, sf_dir), EXT, path)
    m = spark.read.json(path)
    hour = lambda c: F.regexp_replace(F.substring(c, 1, 13), "T", " ")
    return m.select("rows", "train_rows", "test_rows", hour("first_ts").alias("first_hour"), hour("last_ts").alias("last_hour"), F.array_join("features", ",").alias("features"))


@register("au11_file_profile_daily",
          CATALOG_SQL.rsplit("SELECT symbol, 'data_'", 1)[0].rstrip() + f""",
u AS (SELECT symbol, year(ts) AS yr, count_if(ts < TIMESTAMP '{HALF_YEAR_START} 00:00:00') AS k FROM daily GROUP BY 1, 2)
SELECT y.symbol, 'data_' || strftime("end", '%Y-%m-%d') || '_from_' || strftime(start, '%Y-%m-%d') AS name, CAST(n AS BIGINT) AS rows,
       CAST(k AS BIGINT) AS unique_rows, start AS first_date, "end" AS last_date FROM y JOIN u ON y.symbol = u.symbol AND y.yr = u.yr
UNION ALL SELECT symbol, 'data_' || strftime("end", '%Y-%m-%d') || '_from_' || strftime(start, '%Y-%m-%d'), CAST(n AS BIGINT), CAST(n AS BIGINT), start, "end" FROM h""",
          covers=("AU-11", "IO-02"))
def file_profile_daily(spark, sf_dir):
    """Rows, dates and surviving rows of each range file; the half-year file revises the last months."""
    root = scratch_dir(spark, "profile")
    write_history_files(spark, sf_dir, root)
    r = files.with_precedence(files.read_ragged(spark, [f"{root}/ranges", f"{root}/updates"]))
    r = r.withColumn("symbol", F.regexp_extract("_file", r"symbol=([^/]+)", 1)).withColumn("slice", F.struct("symbol", F.col("_name").alias("name")))
    p = audit.file_profile(r, "slice", ("symbol", "Date"), "Date", ("_prec", "_name"))
    return p.select("slice.symbol", "slice.name", "rows", "unique_rows", "first_date", "last_date")


REQUIRED = ["close", "ret", "ma_50", "sentiment", "rsi_14", "macd"]


PRESENT = [c for c in REQUIRED if c in ("close", "ret", "ma_50", "rsi_14")]


@register("au09_missing_columns_bars",
          f"""WITH {BAR_TRAIN_SQL},
c AS (SELECT {', '.join(f'count({c}) AS {c}' for c in PRESENT)} FROM bt)
{' UNION ALL '.join(f"SELECT '{c}' AS column, {str(c in PRESENT).lower()} AS present, {f'(SELECT {c} FROM c)' if c in PRESENT else 'CAST(0 AS BIGINT)'} AS non_null, {f'(SELECT {c} > 0 FROM c)' if c in PRESENT else 'false'} AS usable" for c in REQUIRED)}""",
          covers=("AU-09",))
def missing_columns_bars(spark, sf_dir):
    """Required columns of the training frame, absent ones included."""
    return audit.required_columns(bt(spark, sf_dir), REQUIRED)


def _profile_sql(columns) -> str:
    one = "SELECT '{0}' AS column, count({0}) AS non_null, CAST(min({0}) AS DOUBLE) AS min, CAST(max({0}) AS DOUBLE) AS max, var_samp({0}) AS variance FROM bt"
    return " UNION ALL ".join(one.format(c) for c in columns)


META_SELECTED = ["ret", "ma_50", "rsi_14", "vol_ratio"]
META_COLUMNS = ["open", "high", "low", "close", "volume", "ret", "ma_50", "rsi_14", "range_pct", "vol_ratio", "target", "ret_unscaled", "close_unscaled"]


@register("fs07_feature_metadata_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
p AS ({_profile_sql(META_COLUMNS)})
SELECT *, CASE WHEN "column" IN ({', '.join(f"'{c}'" for c in META_SELECTED)}) THEN 'feature' WHEN "column" = 'target' THEN 'label'
               WHEN "column" LIKE '%_unscaled' THEN 'unscaled' ELSE 'key' END AS role,
       "column" IN ({', '.join(f"'{c}'" for c in EXT)}) AS scaled, "column" IN ({', '.join(f"'{c}'" for c in META_SELECTED)}) AS selected FROM p""", ["min", "max", "variance"]),
          covers=("FS-07",))
def feature_metadata_bars(spark, sf_dir):
    """Roles of the processed frame's columns and what each of them holds."""
    t = bt(spark, sf_dir).select(*META_COLUMNS)
    meta = selection.feature_metadata(t, META_SELECTED, EXT).select("column", "role", "scaled", "selected")
    return clean.column_profile(t, t.columns).join(F.broadcast(meta), "column")  # a row a column


#: What the three rules choose of the training frame's columns, stated for the SQL.
BY_RULE = {
    "exclusion": ["open", "high", "low", "close", "volume", "ret", "ma_5", "ma_10", "ma_20", "ma_50", "ret_5d", "ret_20d", "lag_1", "lag_2", "lag_3", "lag_5", "rsi_14", "range",
                  "range_pct", "true_range", "atr_14", "vol_5d", "vol_20d", "vol_ratio"],
}


@register("pf10_feature_lists_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
p AS ({_profile_sql(BY_RULE['exclusion'])})
SELECT 'exclusion' AS rule, * FROM p
UNION ALL SELECT 'pattern', * FROM p WHERE regexp_matches("column", '(?i){'|'.join(clean.FEATURE_NAME_PATTERNS)}')
UNION ALL SELECT 'no_price', * FROM p WHERE "column" NOT IN ('open', 'high', 'low', 'close')""", ["min", "max", "variance"]),
          covers=("PF-10",))
def feature_lists_bars(spark, sf_dir):
    """What the columns hold that each of the three naming rules chooses from the whole training frame."""
    t = bt(spark, sf_dir)
    by_exclusion = clean.features_by_exclusion(t.columns)
    lists = {"exclusion": by_exclusion, "pattern": clean.features_by_pattern(t.columns), "no_price": clean.non_price_features(by_exclusion)}
    profile = clean.column_profile(t, sorted({c for cs in lists.values() for c in cs}))
    rules = F.filter(F.array(*[F.when(F.col("column").isin(cs), F.lit(rule)) for rule, cs in lists.items()]), lambda r: r.isNotNull())
    return profile.select(F.explode(rules).alias("rule"), "*")


@register("ag06_partial_autocorrelation_three_lags_bars",
          rounded(f"""WITH {BAR_TRAIN_SQL},
d AS (SELECT symbol, ts, seq, ret - avg(ret) OVER (PARTITION BY symbol) AS d FROM bt WHERE split = 'train'),
l AS (SELECT symbol, d, lag(d, 1) OVER ({W}) AS l1, lag(d, 2) OVER ({W}) AS l2, lag(d, 3) OVER ({W}) AS l3 FROM d),
r AS (SELECT symbol, sum(d * l1) / sum(d * d) AS r1, sum(d * l2) / sum(d * d) AS r2, sum(d * l3) / sum(d * d) AS r3 FROM l GROUP BY symbol),
p AS (SELECT *, (r2 - r1 * r1) / (1 - r1 * r1) AS p2, r1 * (1 - (r2 - r1 * r1) / (1 - r1 * r1)) AS q1 FROM r)
SELECT symbol, CAST(1 AS BIGINT) AS lag, r1 AS pacf FROM p UNION ALL SELECT symbol, 2, p2 FROM p
UNION ALL SELECT symbol, 3, (r3 - q1 * r2 - p2 * r1) / (1 - q1 * r1 - p2 * r2) FROM p""", ["pacf"]), covers=("AG-06", "AG-05"))
def partial_autocorrelation_three_lags_bars(spark, sf_dir):
    """Three lags, of which SQL states the recursion's closed form."""
    acf = stats.autocorrelation(bt(spark, sf_dir).filter(F.col("split") == "train"), "ret", 3)
    return stats.partial_autocorrelation(acf)


GREEDY = (("range_pct", "ma_50", "close"), ("vol_5d", "vol_20d", "atr_14"), ("close", "high", "open"))
GREEDY_CORR = 0.3


def _greedy_sql(i: int, names) -> str:
    a, b, c = names
    return f"""g{i} AS (SELECT symbol, abs(corr({a}, {b})) > {GREEDY_CORR} AS c12, abs(corr({a}, {c})) > {GREEDY_CORR} AS c13, abs(corr({b}, {c})) > {GREEDY_CORR} AS c23,
  abs(corr({a}, target)) AS s1, abs(corr({b}, target)) AS s2, abs(corr({c}, target)) AS s3 FROM bt WHERE split = 'train' GROUP BY symbol),
h{i} AS (SELECT *, NOT (c12 AND s1 <= s2) AS a1, NOT (c12 AND s1 > s2) AS a2 FROM g{i}),
k{i} AS (SELECT symbol, {i} AS list, unnest(['{a}', '{b}', '{c}']) AS feature,
  unnest([NOT (a1 AND NOT (c13 AND s1 <= s3)), NOT (a2 AND NOT (c23 AND s2 <= s3)), (a1 AND c13 AND s1 > s3) OR (a2 AND c23 AND s2 > s3)]) AS dropped FROM h{i})"""


@register("fs06_greedy_prune_three_features_bars",
          f"""WITH {BAR_TRAIN_SQL},
{', '.join(_greedy_sql(i, names) for i, names in enumerate(GREEDY))}
SELECT symbol, CAST(list AS BIGINT) AS list, feature, dropped FROM (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2)""", covers=("FS-06",))
def greedy_prune_three_features_bars(spark, sf_dir):
    """Three lists of three features, of which SQL states every way that the prune can go."""
    t = checkpoint(bt(spark, sf_dir).filter(F.col("split") == "train"))
    out = None
    for i, names in enumerate(GREEDY):
        pruned = selection.greedy_prune(stats.correlation_matrix(t, list(names), ["symbol"]), stats.target_correlation(t, list(names), "target", ["symbol"]), names, ["symbol"], GREEDY_CORR)
        pruned = pruned.withColumn("list", F.lit(i))
        out = pruned if out is None else out.unionByName(pruned)
    return out.select("symbol", "list", "feature", "dropped")
