"""Model operators against numpy oracles on the driver's small bar panel."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketframe.operators import arma, linear, scale, selection, stats
from marketframe.operators import features as wn
from marketframe.plans import train
from tests.conftest import SMALL

EXT = wn.EXTENDED_FEATURES
ALPHAS = linear.RIDGE_ALPHAS


@pytest.fixture(scope="module")
def scaled(spark):
    t = train.bar_training_frame(spark, SMALL)
    s = scale.transform_minmax(t, EXT).filter(F.col("split") == "train")
    return s, s.select("symbol", "ts", "seq", "target", *EXT).toPandas().sort_values(["symbol", "ts", "seq"])


def ridge_np(x, y, alpha):
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    if alpha == 0:
        beta = np.linalg.lstsq(xc, yc, rcond=None)[0]
    else:
        beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return ym - xm @ beta, beta


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_fit_linear_matches_numpy(scaled, alpha):
    s, pdf = scaled
    feats = EXT if alpha else ["ret", "ma_50", "atr_14", "vol_5d"]
    got = {r.symbol: (r.intercept, np.array(r.coef)) for r in linear.fit_linear(s, feats, "target", alpha=alpha).collect()}
    for sym, g in pdf.groupby("symbol"):
        b0, beta = ridge_np(g[feats].to_numpy(), g["target"].to_numpy(), alpha)
        pred_np = b0 + g[feats].to_numpy() @ beta
        pred_sp = got[sym][0] + g[feats].to_numpy() @ got[sym][1]
        # compare fitted values (coefficients of near-collinear columns are not unique)
        assert np.allclose(pred_np, pred_sp, atol=1e-8)


def test_wide_gram_matches_covariance(scaled):
    s, pdf = scaled
    g = {r.symbol: r for r in linear.gram(s, EXT, "target", ["symbol"]).collect()}
    for sym, grp in pdf.groupby("symbol"):
        z = grp[EXT + ["target"]].to_numpy()
        c = (z - z.mean(0)).T @ (z - z.mean(0))
        assert g[sym].n == len(z)
        assert np.allclose(linear._full(np.array(g[sym].cm), z.shape[1]), c, rtol=1e-9, atol=1e-9)


def test_ridge_grid_matches_brute_force(scaled):
    s, pdf = scaled
    res = linear.ridge_grid(s, EXT, "target")
    scores = res["scores"].toPandas()
    best = {r.symbol: r.alpha for r in res["best"].collect()}
    for sym, g in pdf.groupby("symbol"):
        x, y = g[EXT].to_numpy(), g["target"].to_numpy()
        n, t = len(y), len(y) // 6
        cv = {}
        for a in ALPHAS:
            mses = []
            for i in range(5):
                end = n - (4 - i) * t
                tr, te = slice(0, end - t), slice(end - t, end)
                b0, beta = ridge_np(x[tr], y[tr], a)
                mses.append(np.mean((y[te] - b0 - x[te] @ beta) ** 2))
                row = scores[(scores.symbol == sym) & (scores.fold == i + 1) & (scores.alpha == a)]
                assert np.isclose(row.mse.iloc[0], mses[-1], rtol=1e-7)
            cv[a] = np.mean(mses)
        want = min(ALPHAS, key=lambda a: (cv[a], ALPHAS.index(a)))
        assert best[sym] == want


def test_pacf_matches_yule_walker(spark, scaled):
    s, pdf = scaled
    acf = stats.autocorrelation(s, "ret", 6)
    pacf = {(r.symbol, r.lag): r.pacf for r in stats.partial_autocorrelation(acf).collect()}
    for sym, g in pdf.groupby("symbol"):
        x = g["ret"].to_numpy()
        d = x - x.mean()
        r = np.array([1.0] + [np.sum(d[k:] * d[:-k]) / np.sum(d * d) for k in range(1, 7)])
        for k in range(1, 7):
            mat = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            phi = np.linalg.solve(mat, r[1:k + 1])
            assert np.isclose(pacf[(sym, k)], phi[-1], atol=1e-9)


PRUNE_CASES = [
    # features a, b, c with |target corr|; pairs above the threshold; who stays
    ((0.5, 0.2, 0.1), {"ab"}, "ac"),              # b meets the stronger a
    ((0.2, 0.5, 0.1), {"ab"}, "bc"),              # b is stronger: a goes
    ((0.3, 0.3, 0.1), {"ab"}, "bc"),              # a tie goes to the newcomer
    ((0.3, None, 0.1), {"ab"}, "bc"),             # and so does a missing score
    ((0.5, 0.4, 0.3), {"ab", "bc"}, "ac"),        # b is out when c comes, so c meets nobody
    ((0.3, 0.5, 0.4), {"ab", "ac", "bc"}, "b"),   # a goes to b, c to b
    ((0.5, 0.1, 0.3), {"ac", "bc"}, "a"),         # c goes to a and takes the weaker b with it
    ((0.1, 0.2, 0.3), set(), "abc"),
]


@pytest.mark.parametrize("scores, high, stay", PRUNE_CASES)
def test_greedy_prune_hand_worked(spark, scores, high, stay):
    pairs = [(x, y, -0.96 if x + y in high else 0.95) for x, y in ("ab", "ac", "bc")]
    for by in ([], ["g"]):
        m = spark.createDataFrame(pairs, "feature_a string, feature_b string, corr double")
        t = spark.createDataFrame(list(zip("abc", scores)), "feature string, corr double")
        if by:
            m, t = (d.withColumn("g", F.lit(1)) for d in (m, t))
        got = selection.greedy_prune(m, t, ["a", "b", "c"], by).collect()
        assert "".join(sorted(r.feature for r in got if not r.dropped)) == stay and len(got) == 3


def test_pooled_gram_and_fits(spark, scaled):
    s, pdf = scaled
    for feats in (EXT, ["ret", "ma_50"]):
        x, y = pdf[feats].to_numpy(), pdf["target"].to_numpy()
        (r,) = linear.fit_linear(s, feats, "target", by=(), alpha=1.0).collect()
        b0, beta = ridge_np(x, y, 1.0)
        assert r.n == len(x) and np.allclose(r.intercept + x @ np.array(r.coef), b0 + x @ beta, atol=1e-8)
    scored = linear.score_linear(s, linear.fit_linear(s, ["ret"], "target", by=()), ["ret"], by=())
    assert scored.filter("pred is null").count() == 0
    assert linear.fit_linear(s.limit(0), ["ret"], "target", by=()).count() == 0
    cm = stats.correlation_matrix(s, EXT, (), complete=True).collect()
    want = pdf[EXT].corr()
    assert len(cm) == len(EXT) * (len(EXT) - 1) // 2
    assert all(np.isclose(r["corr"], want.loc[r.feature_a, r.feature_b], atol=1e-9) for r in cm)


def test_adf_of_constant_and_long_series(spark):
    r = np.random.default_rng(3)
    flat = [("flat", i, i, 5.0) for i in range(100)]
    walk = [("walk", i, i, float(v)) for i, v in enumerate(np.cumsum(r.normal(size=20_000)))]
    noise = [("noise", i, i, float(v)) for i, v in enumerate(r.normal(size=400))]
    d = spark.createDataFrame(flat + walk + noise, "symbol string, ts bigint, seq bigint, close double")
    got = {x.symbol: x for x in arma.adf_test(d, "close").collect()}
    assert got["flat"].adf_stat is None and got["flat"].p_value is None and got["flat"].stationary is None
    assert got["noise"].stationary and got["noise"].p_value < 1e-6
    assert not got["walk"].stationary and got["walk"].p_value > 0.05 and got["walk"].nobs >= 20_000 - 1 - 46
    assert abs(arma.adf_p_value(-2.86154) - 0.05) < 2e-3 and abs(arma.adf_p_value(-3.43035) - 0.01) < 1e-3
    assert arma.adf_p_value(-30) == 0 and arma.adf_p_value(5) == 1


def test_adf_statistic_matches_numpy(spark):
    from marketframe.sources import panels
    d = panels.daily(spark, SMALL)
    res = {r.symbol: r for r in arma.adf_test(d, "close", maxlag=2).collect()}
    pdf = d.toPandas().sort_values(["symbol", "ts"])
    for sym, g in pdf.groupby("symbol"):
        y = g["close"].to_numpy()
        p = res[sym].used_lag
        dy = np.diff(y)
        rows_ = [(dy[t], y[t], *[dy[t - i] for i in range(1, p + 1)]) for t in range(p, len(dy))]
        a = np.array(rows_)
        x = np.column_stack([np.ones(len(a)), a[:, 1:]])
        beta, sse = np.linalg.lstsq(x, a[:, 0], rcond=None)[:2]
        s2 = sse[0] / (len(a) - x.shape[1])
        se = np.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1])
        assert res[sym].nobs == len(a)
        assert np.isclose(res[sym].adf_stat, beta[1] / se, rtol=1e-6)


def test_arma_orders_are_in_grid(spark):
    t = train.bar_training_frame(spark, SMALL)
    o = arma.select_order(t, "ret")["orders"].collect()
    assert o and all(0 <= r.p <= 5 and 0 <= r.q <= 5 for r in o)
    wf = arma.walk_forward(t, "ret").toPandas()
    assert wf["pred"].notna().all()


def test_sequences_shape(spark):
    t = train.bar_training_frame(spark, SMALL)
    w = wn.sequences(t, ["ret", "rsi_14"], 4).first().window
    assert len(w) == 4 and all(len(step) == 2 for step in w)


def test_prune_from_one_gram_equals_the_joins(spark):
    rng = np.random.default_rng(11)
    rows = []
    for g in range(6):
        base = rng.normal(size=(80, 4))
        for x in base:
            near = x[0] + 0.05 * rng.normal()
            rows.append((g, *map(float, (x[0], near, x[1], x[1], 1.0 if g == 2 else x[2], -x[2] + 0.01 * rng.normal(), x[0] + x[1] + 0.3 * x[3]))))
    feats = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, ["symbol", *feats, "target"])
    for keep in ([], ["b"], ["a", "b", "c"], feats):
        scores = stats.target_correlation(df, feats, "target", ["symbol"])
        want = selection.redundancy_prune(selection.candidates(scores, feats, ["symbol"], keep), stats.correlation_matrix(df, feats, ["symbol"], complete=True), ["symbol"])
        got = selection.pruned(linear.gram(df, feats, "target", ["symbol"]), feats, ["symbol"], keep)
        assert got.columns == want.columns
        a, b = (sorted((r.symbol, r.feature, r.ord, r.must_keep, None if r.abs_corr is None else round(r.abs_corr, 9)) for r in d.collect()) for d in (got, want))
        assert a == b and len(a) > 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    one = selection.pruned(linear.gram(df, ["a"], "target", ()), ["a"], (), [])
    assert [(r.feature, r.ord) for r in one.collect()] == [("a", 0)]


def test_backtest_metrics_in_one_aggregate(spark):
    from marketframe.operators import forecast

    t = train.bar_features(spark, SMALL)
    coefs = linear.fit_linear(train.bar_training_frame(spark, SMALL).filter(F.col("split") == "train"), ["ret"], "target")
    out = forecast.backtest(t, ["ret"], coefs, n=30)
    rows, met = out["rows"].toPandas(), out["metrics"].toPandas().set_index("symbol")
    last = t.where("ret is not null").toPandas().sort_values(["symbol", "ts", "seq"]).groupby("symbol").tail(30)
    assert sorted(zip(rows.symbol, rows.ts, rows.seq)) == sorted(zip(last.symbol, last.ts, last.seq)) and len(met) == last.symbol.nunique()
    for sym, g in rows.groupby("symbol"):
        ok = g.dropna(subset=["actual", "pred"])
        assert met.n[sym] == len(ok) < len(g)  # the latest row has no next return
        assert np.isclose(met.rmse[sym], np.sqrt(((ok.actual - ok.pred) ** 2).mean()), rtol=1e-9)
        assert np.isclose(met.directional_accuracy[sym], (np.sign(ok.actual) == np.sign(ok.pred)).mean())
        assert np.isclose(met.price_mae[sym], (g.close - g.pred_price).abs().mean(), rtol=1e-9)
    assert forecast.backtest(t, ["ret"], coefs, min_history=10**6)["metrics"].count() == 0
