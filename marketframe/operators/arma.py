"""Autoregressive models and unit-root tests from window-built designs and Gram
aggregates (SURVEY §2.6 AG-17, §2.8 ML-08..ML-10).

Re-aimed from a per-series state-space MLE solver to estimators that distribute:

* ARMA(p, q) with drift by Hannan-Rissanen: a long AR(m) fitted per series gives
  innovation estimates; ARMA regressions on lagged values and lagged innovations are
  then plain least squares. All (p, q) candidates come from **one** Gram per series
  (sub-matrices), so order selection by AIC is a single aggregate pass. Not
  MLE-identical; documented.
* Differencing is chosen by the ADF test, for all series and differences in one plan.
* The walk-forward one-step forecast runs the moving-average recursion: affine maps per block, composed
  by a prefix scan, then each block from its carried state. Coefficients are fixed or refitted as it goes from
  prefixes of the blocks' Gram rows.
* Lags of a series too long for one task come from blocks with halos (``layout``).
* ADF: ``Δy_t = a + g y_{t-1} + Σ d_i Δy_{t-i}``; lag by AIC on a common sample,
  refit on the maximal sample for the chosen lag, t-statistic of ``g`` compared with
  the MacKinnon (2010) response-surface critical values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators import layout, linear
from marketframe.operators.scan import prefix_scan
from marketframe.session import checkpoint
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the published response surface (MacKinnon 2010,
# constant, one variable): tau = b0 + b1/T + b2/T^2 + b3/T^3 for 1%, 5%, 10%.
ADF_CRIT_CONST = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}

# Fixed values that must equal the published p-value surface (MacKinnon 1994, constant, one
# variable): the normal distribution of a polynomial of the statistic, one below the switch and one above it.
ADF_P_SWITCH, ADF_P_RANGE = -1.61, (-18.83, 2.74)
ADF_P_LOW = (2.1659, 1.4412, 0.038269)
ADF_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(stat: float) -> float:
    """Approximate p-value of the statistic under a unit root."""
    if not ADF_P_RANGE[0] <= stat <= ADF_P_RANGE[1]:
        return float(stat > 0)
    terms = ADF_P_LOW if stat <= ADF_P_SWITCH else ADF_P_HIGH
    z = sum(b * stat**i for i, b in enumerate(terms))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def difference_order(df: DataFrame, col: str = "close", spec: SeriesSpec = DEFAULT_SPEC, max_d: int = 2,
                     maxlag: int | None = None, block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """ML-08: how often a series is differenced until the ADF test finds it stationary at 5%, at most
    ``max_d`` times: ``(keys..., d)``. All series and all their differences are tested in one plan, keyed by
    (series, d). A difference without variance needs no further one."""
    x = differences(df, col, spec, max_d, block_rows, chunk)
    tries = x.withColumn("__t", F.explode(F.array(*[F.struct(F.lit(k).alias("d"), F.col(f"__x{k}").alias("x")) for k in range(max_d)])))
    tries = tries.select(*spec.keys, *spec.order, "__t.*").where(F.col("x").isNotNull())
    tested = adf_test(tries, "x", spec.with_keys("d"), maxlag, block_rows, chunk)
    # without a statistic: no variance or too few rows are left as they are, an exact trend is differenced
    flat = tries.groupBy(*spec.keys, "d").agg((F.min("x") == F.max("x")).alias("__flat"))
    tested = tested.join(flat, [*spec.keys, "d"])
    fits = F.coalesce("stationary", F.col("__flat") | (F.col("nobs") <= 3))
    return tested.groupBy(*spec.keys).agg(F.coalesce(F.min(F.when(fits, F.col("d"))), F.lit(max_d)).cast("int").alias("d"))


def differences(df: DataFrame, col: str, spec: SeriesSpec = DEFAULT_SPEC, max_d: int = 2, block_rows: int = 1_000_000,
                chunk: str = "hour") -> DataFrame:
    """``df`` without NULL values of ``col``, with ``__x0`` .. ``__x<max_d>``, its differences; NULL where they reach before the first row."""
    def build(d: DataFrame, blocked: SeriesSpec) -> DataFrame:
        d = d.withColumn("__x0", F.col(col))
        for k in range(1, max_d + 1):
            d = d.withColumn(f"__x{k}", F.col(f"__x{k - 1}") - F.lag(f"__x{k - 1}", 1).over(blocked.window()))
        return d

    return layout.on_blocks(df.where(F.col(col).isNotNull()), build, spec, max_d, 0, block_rows, chunk)


def arma_design(df: DataFrame, col: str, max_p: int, max_q: int, m: int = 12, spec: SeriesSpec = DEFAULT_SPEC, fit_filter=None,
                block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """Rows with lagged values ``y_l1..``, the residual ``e`` of an AR(m) fitted per series on the ``fit_filter`` rows, and its lags
    ``e_l1..``; with position ``__pos`` and block ``__block``. Blocks of a long series carry the rows
    before them that these lags reach."""
    frame, blocked = layout.halo_blocks(df.where(F.col(col).isNotNull()), spec, m + max_q, 0, block_rows, chunk)
    w, reach = blocked.window(), max(max_p, m if max_q else 0)
    frame = checkpoint(frame.withColumns({f"y_l{i}": F.lag(col, i).over(w) for i in range(1, reach + 1)}))
    if max_q:
        own = frame.where(~F.col("__halo"))
        feats = [f"y_l{i}" for i in range(1, m + 1)]
        coefs = linear.fit_linear(own.where(fit_filter) if fit_filter is not None else own, feats, col, spec.keys)
        frame = linear.score_linear(frame, coefs, feats, spec.keys, out="__yhat").withColumn("e", F.col(col) - F.col("__yhat"))
        frame = frame.withColumns({f"e_l{j}": F.lag("e", j).over(w) for j in range(1, max_q + 1)}).drop("__yhat")
    return frame.where(~F.col("__halo")).drop("__halo", "__chunk", *[f"y_l{i}" for i in range(max_p + 1, reach + 1)])


def _design_names(max_p: int, max_q: int) -> list[str]:
    return [f"y_l{i}" for i in range(1, max_p + 1)] + [f"e_l{j}" for j in range(1, max_q + 1)]


def _solve_order(n: int, mean: np.ndarray, c: np.ndarray, p: int, q: int, max_p: int) -> tuple[float, np.ndarray, float]:
    """(intercept, coefficients over the whole design, sse) of ARMA(p, q) from the design's Gram."""
    k = len(mean) - 1
    ix = [*range(p), *(max_p + j for j in range(q))]
    sel = [*ix, k]
    b0, beta = linear._solve(n, mean[sel], c[np.ix_(sel, sel)], 0.0) if ix else (float(mean[k]), np.zeros(0))
    full = np.zeros(k)
    full[ix] = beta
    return b0, full, linear._sse(n, mean[sel], c[np.ix_(sel, sel)], b0, beta)


def order_grid(gram: DataFrame, by: Sequence[str], max_p: int, max_q: int) -> DataFrame:
    """Every (p, q) of each Gram row: ``(by..., p, q, n, sigma2, aic, intercept, coef)``."""
    by, k = list(by), max_p + max_q
    schema = T.StructType([gram.schema[c] for c in by] + [T.StructField(c, T.LongType()) for c in ("p", "q", "n")]
                          + [T.StructField(c, T.DoubleType()) for c in ("sigma2", "aic", "intercept")] + [T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                n, mean, c = int(r.n), np.asarray(r.mean, float), linear._full(np.asarray(r.cm, float), k + 1)
                for p in range(max_p + 1):
                    for q in range(max_q + 1):
                        b0, full, sse = _solve_order(n, mean, c, p, q, max_p)
                        s2 = sse / n if n else float("nan")
                        aic = n * math.log(s2) + 2 * (p + q + 2) if s2 > 0 else float("nan")
                        out.append([getattr(r, x) for x in by] + [p, q, n, s2, aic, b0, full.tolist()])
            yield pd.DataFrame(out, columns=schema.names)

    return gram.mapInPandas(run, schema)


def select_order(df: DataFrame, col: str = "ret", max_p: int = 5, max_q: int = 5, m: int = 12, spec: SeriesSpec = DEFAULT_SPEC,
                 split_col: str | None = "split", block_rows: int = 1_000_000, chunk: str = "hour") -> dict[str, DataFrame]:
    """ML-08: ARMA(p, q) with drift by Hannan-Rissanen, order by minimum AIC (ties: the smaller p, then q).

    Returns ``candidates`` ``(keys..., p, q, n, sigma2, aic, intercept, coef)``, ``orders`` (best per
    series), the ``design`` frame and the ``names`` of its regressors, in the order of ``coef``."""
    train = F.col(split_col) == "train" if split_col and split_col in df.columns else None
    design = checkpoint(arma_design(df, col, max_p, max_q, m, spec, train, block_rows, chunk))
    names, by = _design_names(max_p, max_q), list(spec.keys)
    cands = order_grid(linear.gram(design.where(train) if train is not None else design, names, col, by), by, max_p, max_q)
    best = cands.where(~F.isnan("aic")).groupBy(*by).agg(
        F.min_by(F.struct("p", "q", "n", "sigma2", "aic", "intercept", "coef"), F.struct("aic", "p", "q")).alias("b"))
    return {"candidates": cands, "orders": best.select(*by, "b.*"), "design": design, "names": names}


def innovations(frame: DataFrame, col: str, spec: SeriesSpec, unit: str = "__unit", span: int = 512) -> DataFrame:
    """The moving-average recursion ``e_t = u_t - sum_j theta_j e_{t-j}`` with ``e = 0`` where ``u`` is NULL, and the one-step forecast
    ``pred = y_t - e_t``, NULL there.

    ``frame`` has ``u`` (the value without intercept and autoregressive part), ``theta``, ``__pos`` and the ``unit`` of each row, consecutive rows of one
    theta. A unit maps the innovations before it to its last ones by an affine map ``(A, b)``: A is a power of theta's
    companion matrix, b the recursion from zero. The maps are composed over the units before (:func:`scan.prefix_scan`), and each
    unit then runs from its state. So a series is never in one task, and where units are cut changes nothing but rounding."""
    by = list(spec.keys)
    fields = [frame.schema[c] for c in [*by, unit]]
    maps_schema = T.StructType([*fields, T.StructField("a", T.ArrayType(T.DoubleType())), T.StructField("b", T.ArrayType(T.DoubleType()))])

    def run(u: np.ndarray, theta: list[float], state: list[float]) -> tuple[np.ndarray, list[float]]:
        e, last = np.zeros(len(u)), list(state)
        for t, x in enumerate(u.tolist()):
            now = 0.0 if math.isnan(x) else x - sum(th * s for th, s in zip(theta, last, strict=True))
            e[t] = now
            last = [now, *last[:-1]] if last else last
        return e, last

    def to_map(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__pos")
        theta = [float(x) for x in pdf["theta"].iloc[0]]
        q = len(theta)
        a = np.zeros((q, q))
        if q:
            a[0] = [-x for x in theta]
            a[1:, :-1] = np.eye(q - 1)
        b = run(pdf["u"].to_numpy(float), theta, [0.0] * q)[1]
        row = [pdf[c].iloc[0] for c in [*by, unit]] + [np.linalg.matrix_power(a, len(pdf)).ravel().tolist() if q else [], b]
        return pd.DataFrame([row], columns=maps_schema.names)

    def compose(first: tuple, then: tuple) -> tuple:
        q = len(first[1])
        a1, a2 = (np.asarray(x[0], float).reshape(q, q) for x in (first, then))
        return (a2 @ a1).ravel().tolist(), (a2 @ np.asarray(first[1], float) + np.asarray(then[1], float)).tolist()

    maps = frame.select(*by, unit, "__pos", "u", "theta").groupBy(*by, unit).applyInPandas(to_map, maps_schema)
    states = prefix_scan(maps, by, unit, ["a", "b"], compose, span).select(*by, unit, F.col("before_b").alias("__state"))
    out_schema = T.StructType([*frame.schema.fields, T.StructField("e_t", T.DoubleType()), T.StructField("pred", T.DoubleType())])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__pos")
        theta, state = [float(x) for x in pdf["theta"].iloc[0]], pdf["__state"].iloc[0]
        u = pdf["u"].to_numpy(float)
        e, _ = run(u, theta, [0.0] * len(theta) if state is None else [float(x) for x in state])
        known = ~np.isnan(u)
        pred = np.where(known, pdf[col].to_numpy(float) - e, np.nan)
        return pdf.drop(columns="__state").assign(e_t=np.where(known, e, np.nan), pred=pred)

    done = frame.join(states, [*by, unit]).groupBy(*by, unit).applyInPandas(finish, out_schema)
    return done.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("e_t", "pred")})


def refit_coefs(design: DataFrame, names: Sequence[str], col: str, orders: DataFrame, max_p: int, spec: SeriesSpec, span: int = 512) -> DataFrame:
    """ML-09, refitted as it goes: ``(keys..., __rb, intercept, coef)``, for each block ``__rb`` of the design the fit, in the series' order
    (p, q), of all rows of the blocks before it. Each block's Gram is made once; prefixes are merged co-moments."""
    by, k = list(spec.keys), len(names)
    blocks = linear.gram(design, names, col, [*by, "__rb"])

    def merge(first: tuple, then: tuple) -> tuple:
        n, mean, c = linear._merge([(int(x[0]), np.asarray(x[1], float), linear._full(np.asarray(x[2], float), k + 1)) for x in (first, then)])
        return n, mean.tolist(), c[np.triu_indices(k + 1)].tolist()

    before = prefix_scan(blocks, by, "__rb", ["n", "mean", "cm"], merge, span).where(F.col("before_n").isNotNull())
    rows = before.select(*by, F.col("__rb").alias("rb"), *[F.col(f"before_{c}").alias(c) for c in ("n", "mean", "cm")]).join(orders.select(*by, "p", "q"), by)
    schema = T.StructType([*[rows.schema[c] for c in by], T.StructField("__rb", T.LongType()), *linear.COEF_FIELDS[1:]])

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                b0, full, _ = _solve_order(int(r.n), np.asarray(r.mean, float), linear._full(np.asarray(r.cm, float), k + 1), int(r.p), int(r.q), max_p)
                out.append([getattr(r, c) for c in by] + [int(r.rb), b0, full.tolist()])
            yield pd.DataFrame(out, columns=schema.names)

    return rows.mapInPandas(run, schema)


def walk_forward(df: DataFrame, col: str = "ret", max_p: int = 5, max_q: int = 5, m: int = 12, spec: SeriesSpec = DEFAULT_SPEC,
                 split_col: str = "split", max_d: int = 0, refit_rows: int | None = None, block_rows: int = 1_000_000,
                 chunk: str = "hour") -> DataFrame:
    """ML-09: one-step-ahead forecasts of the test split: row t+1 is predicted from the values up to t and the
    innovations of the recursion (:func:`innovations`, from zero at the series' start): ``(keys..., ts, seq, actual, pred, p, q, d)``.

    The order is chosen on the training split. Coefficients are those of the training split, or, with ``refit_rows``, are fitted
    again before every so many test rows on all rows before them (the lagged innovations among the regressors stay those of
    the training split's long autoregression). With ``max_d`` a series is differenced as :func:`difference_order` says and forecasts
    are those of ``col`` again. A forecast whose lags reach before the first row is NULL."""
    by = list(spec.keys)
    x = differences(df, col, spec, max_d, block_rows, chunk)
    if max_d:
        x = x.join(difference_order(x.where(F.col(split_col) == "train"), col, spec, max_d, None, block_rows, chunk), by)
    else:
        x = x.withColumn("d", F.lit(0))
    x = x.withColumn("__y", F.coalesce(*[F.when(F.col("d") == k, F.col(f"__x{k}")) for k in range(max_d + 1)])).drop(*[f"__x{k}" for k in range(max_d + 1)])
    sel = select_order(x, "__y", max_p, max_q, m, spec, split_col, block_rows, chunk)
    test, orders = F.col(split_col) == "test", checkpoint(sel["orders"])
    design = sel["design"]
    start = F.col("__block") * F.lit(block_rows)
    if refit_rows:
        cut = design.where(test).groupBy(*by).agg(F.min("__pos").alias("__cut"))
        rb = F.floor((F.col("__pos") - F.col("__cut")) / F.lit(refit_rows))
        design = design.join(cut, by, "left").withColumn("__rb", F.when(test, rb + 1).otherwise(F.lit(0)).cast("bigint"))
        later = refit_coefs(design, sel["names"], "__y", orders, max_p, spec)
        fits = later.where("__rb > 0").unionByName(orders.select(*by, F.lit(0).cast("bigint").alias("__rb"), "intercept", "coef"))
        design = design.withColumn("__unit", F.when(test, F.greatest(start, F.col("__cut") + rb * F.lit(refit_rows))).otherwise(start))
        coefs = fits.join(orders.select(*by, "p", "q"), by)
        fitted = design.join(coefs, [*by, "__rb"])
    else:
        fitted = design.withColumn("__unit", start).join(orders.select(*by, "intercept", "coef", "p", "q"), by)
    part = F.col("intercept")
    for i in range(max_p):
        part = part + F.when(F.col("p") > i, F.col("coef")[i] * F.col(f"y_l{i + 1}")).otherwise(F.lit(0.0))
    theta = F.slice("coef", max_p + 1, max_q) if max_q else F.array().cast("array<double>")
    frame = fitted.select(*by, *spec.order, "__pos", F.col("__unit").cast("bigint").alias("__unit"), split_col, F.col(col).alias("__level"), "__y", "p", "q", "d",
                          (F.col("__y") - part).alias("u"), theta.alias("theta"))
    out = innovations(frame, "__y", spec, span=512 * min(refit_rows or block_rows, block_rows))
    # what was taken from the level by differencing is known before the row
    back = F.col("pred") + F.col("__level") - F.col("__y")
    return out.where(test).select(*by, *spec.order, F.col("__level").alias("actual"), back.alias("pred"), "p", "q", "d")


def adf_test(df: DataFrame, col: str = "close", spec: SeriesSpec = DEFAULT_SPEC,
             maxlag: int | None = None, block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """AG-17: augmented Dickey-Fuller test with a constant, lag by AIC.

    Output ``(keys..., nobs, used_lag, adf_stat, p_value, crit_1, crit_5, crit_10, stationary)``;
    ``stationary`` is ``adf_stat < crit_5`` (the 5% decision). A series without variance
    (or with too few rows) has a NULL statistic. Without ``maxlag`` the lag design is as wide as
    the longest series asks for, ``12 (n/100)^(1/4)``: one count per series is run for that."""
    by = list(spec.keys)
    d = df.filter(F.col(col).isNotNull())
    # the default grows with the series: 12 * (n/100)^(1/4), at most n/2 - 2
    lags = lambda n: F.greatest(F.least(F.ceil(F.lit(12.0) * F.pow(n / 100.0, 0.25)), F.floor(n / 2) - 2), F.lit(0)).cast("int")
    cap = maxlag if maxlag is not None else d.groupBy(*by).count().agg(F.max(lags(F.col("count")))).first()[0] or 0
    # a long series is cut into blocks, each with the rows before it that the lags reach
    d, blocked = layout.halo_blocks(d, spec, cap + 2, 0, max(block_rows, cap + 3), chunk)
    w = blocked.window()
    d = d.withColumns({"__dy": F.col(col) - F.lag(col, 1).over(w), "__ylag": F.lag(col, 1).over(w),
                       "__maxlag": lags(F.col("__n")) if maxlag is None else F.lit(maxlag)})
    d = d.withColumns({f"__dl{i}": F.lag("__dy", i).over(w) for i in range(1, cap + 1)})
    d = d.where(~F.col("__halo")).withColumn("__pos", F.col("__pos") + 1)
    names = ["__ylag"] + [f"__dl{i}" for i in range(1, cap + 1)]
    # a regression with lag p reads only the first 1 + p regressors of the Gram, so
    # the unused (possibly NULL) higher lags can be zero-filled instead of masked
    d = d.na.fill(0.0, subset=[f"__dl{i}" for i in range(1, cap + 1)])
    # the lag design feeds three aggregates; a reliable checkpoint (shared
    # spark.checkpoint.dir) computes the windows once and keeps the plans small
    d = checkpoint(d.select(*by, "__pos", "__maxlag", "__dy", *names))
    common = d.filter(F.col("__pos") > F.col("__maxlag") + 1)
    g_common = linear.gram(common, names, "__dy", by).join(
        d.groupBy(*by).agg(F.max("__maxlag").alias("maxlag")), by)
    k = len(names)

    key_fields = [g_common.schema[c] for c in by]
    sel_schema = T.StructType(key_fields + [T.StructField("used_lag", T.LongType())])

    def choose(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                n = int(r.n)
                mean = np.asarray(r.mean, float)
                c = linear._full(np.asarray(r.cm, float), k + 1)
                best, best_aic = 0, float("inf")
                for p in range(int(r.maxlag) + 1):
                    sel = list(range(1 + p)) + [k]
                    b0, beta = linear._solve(n, mean[sel], c[np.ix_(sel, sel)], 0.0)
                    sse = linear._sse(n, mean[sel], c[np.ix_(sel, sel)], b0, beta)
                    if not sse > 1e-12 * max(c[k, k], 1e-300):
                        continue  # an exact fit tells nothing of the order
                    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(sse / n) + 1)
                    aic = -2 * llf + 2 * (p + 2)
                    if aic < best_aic:
                        best, best_aic = p, aic
                out.append([getattr(r, x) for x in by] + [best])
            yield pd.DataFrame(out, columns=by + ["used_lag"])

    chosen = g_common.mapInPandas(choose, sel_schema)
    # refit for the chosen lag on its maximal sample (rows with pos > lag + 1): the
    # chosen-lag table has one row per series and joins back by key
    rows = d.join(chosen.withColumnRenamed("used_lag", "lag_sel"), by)
    rows = rows.filter(F.col("__pos") > F.col("lag_sel") + 1)
    full = linear.gram(rows, names, "__dy", [*by, "lag_sel"])
    out_schema = T.StructType(key_fields + [T.StructField("nobs", T.LongType()), T.StructField("used_lag", T.LongType()),
                                            T.StructField("adf_stat", T.DoubleType()), T.StructField("p_value", T.DoubleType())])

    def stat(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                n, p = int(r.n), int(r.lag_sel)
                mean = np.asarray(r.mean, float)
                c = linear._full(np.asarray(r.cm, float), k + 1)
                sel = list(range(1 + p)) + [k]
                cs = c[np.ix_(sel, sel)]
                b0, beta = linear._solve(n, mean[sel], cs, 0.0)
                sse = linear._sse(n, mean[sel], cs, b0, beta)
                dof = n - (p + 2)
                t = None
                if dof > 0 and cs[0, 0] > 0 and sse > 1e-12 * cs[-1, -1]:
                    var = np.linalg.pinv(cs[:-1, :-1])[0, 0] * sse / dof
                    t = beta[0] / math.sqrt(var) if var > 0 else None
                out.append([getattr(r, x) for x in by] + [n, p, t, None if t is None else adf_p_value(t)])
            yield pd.DataFrame(out, columns=by + ["nobs", "used_lag", "adf_stat", "p_value"]).astype({"adf_stat": float, "p_value": float})

    res = full.mapInPandas(stat, out_schema).withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("adf_stat", "p_value")})
    n = F.col("nobs").cast("double")
    crit = {k2: v[0] + v[1] / n + v[2] / (n * n) + v[3] / (n * n * n) for k2, v in ADF_CRIT_CONST.items()}
    return res.withColumns({"crit_1": crit["1%"], "crit_5": crit["5%"], "crit_10": crit["10%"]}).withColumn(
        "stationary", F.col("adf_stat") < F.col("crit_5"))


__all__: Sequence[str] = ["difference_order", "differences", "select_order", "walk_forward", "innovations", "refit_coefs", "adf_test"]
