"""ARMA by Hannan-Rissanen, differencing, the moving-average recursion and refits against plain numpy loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.operators import arma
from marketframe.operators.scan import prefix_scan


def simulate(phi, theta, n, seed, c=0.01):
    r = np.random.default_rng(seed)
    e, y = r.normal(0, 1, n + 200), np.zeros(n + 200)
    for t in range(3, n + 200):
        y[t] = c + sum(p * y[t - 1 - i] for i, p in enumerate(phi)) + e[t] + sum(q * e[t - 1 - j] for j, q in enumerate(theta))
    return y[200:]


SERIES = {"a11": simulate([0.6], [0.4], 700, 1), "a22": simulate([0.5, -0.3], [0.4, 0.25], 900, 2), "a10": simulate([0.7], [], 400, 3)}


def panel(spark, series, fraction=0.8):
    rows = [(k, i, i, float(v), "train" if i < int(len(y) * fraction) else "test") for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "symbol string, ts bigint, seq bigint, y double, split string").repartition(5)


def fit(x, y):
    return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]


def design(y, n_train, max_p, max_q, m):
    """Lags of y and of the residuals of an AR(m) fitted on the training rows; NaN where they reach before the first row."""
    lag = lambda x, k: np.concatenate([np.full(k, np.nan), x[:-k]])
    long = np.column_stack([lag(y, i) for i in range(1, m + 1)])
    b = fit(long[m:n_train], y[m:n_train])
    e = y - b[0] - long @ b[1:]
    return np.column_stack([lag(y, i) for i in range(1, max_p + 1)] + [lag(e, j) for j in range(1, max_q + 1)])


def candidates(y, n_train, max_p, max_q, m):
    x = design(y, n_train, max_p, max_q, m)
    ok = ~np.isnan(x).any(axis=1) & (np.arange(len(y)) < n_train)
    out = {}
    for p in range(max_p + 1):
        for q in range(max_q + 1):
            cols = [*range(p), *(max_p + j for j in range(q))]
            b = fit(x[ok][:, cols], y[ok])
            sse = float(np.sum((y[ok] - b[0] - x[ok][:, cols] @ b[1:]) ** 2))
            n = int(ok.sum())
            out[p, q] = (n, sse / n, n * np.log(sse / n) + 2 * (p + q + 2), b)
    return out


def recursion(y, fits, p):
    """Forecasts by a plain loop; ``fits(t)`` has intercept, phi and theta of row t."""
    e, pred = np.zeros(len(y)), np.full(len(y), np.nan)
    for t in range(len(y)):
        b0, phi, theta = fits(t)
        if t >= p:
            pred[t] = b0 + sum(f * y[t - 1 - i] for i, f in enumerate(phi)) + sum(h * e[t - 1 - j] for j, h in enumerate(theta) if t - 1 - j >= 0)
            e[t] = y[t] - pred[t]
    return pred


def test_orders_equal_numpy(spark):
    got = arma.select_order(panel(spark, SERIES), "y", 2, 2, 8, block_rows=150)
    best = {r.symbol: r for r in got["orders"].collect()}
    for k, y in SERIES.items():
        want = candidates(y, int(len(y) * 0.8), 2, 2, 8)
        for r in got["candidates"].where(F.col("symbol") == k).collect():
            n, s2, aic, b = want[r.p, r.q]
            assert r.n == n and np.isclose(r.sigma2, s2, rtol=1e-9) and np.isclose(r.aic, aic, rtol=1e-9) and np.isclose(r.intercept, b[0], atol=1e-9)
        p, q = min(want, key=lambda o: (want[o][2], *o))
        assert (best[k].p, best[k].q) == (p, q)
    assert (best["a10"].p, best["a10"].q) == (1, 0)


@pytest.mark.parametrize("block_rows", [1_000_000, 97, 11])
def test_recursion_equals_a_plain_loop(spark, block_rows):
    got = arma.walk_forward(panel(spark, SERIES), "y", 2, 2, 8, block_rows=block_rows).toPandas()
    for k, y in SERIES.items():
        n = int(len(y) * 0.8)
        want = candidates(y, n, 2, 2, 8)
        p, q = min(want, key=lambda o: (want[o][2], *o))
        b = want[p, q][3]
        pred = recursion(y, lambda t: (b[0], b[1 : 1 + p], b[1 + p :]), p)  # noqa: B023
        mine = got[got.symbol == k].sort_values("ts")
        assert np.allclose(mine["pred"].to_numpy(), pred[n:], atol=1e-9) and np.allclose(mine["actual"], y[n:])
    assert set(got.q) != {0}


@pytest.mark.parametrize("refit_rows,block_rows", [(25, 1_000_000), (40, 60), (7, 13)])
def test_refits_equal_numpy_at_every_block(spark, refit_rows, block_rows):
    got = arma.walk_forward(panel(spark, SERIES), "y", 1, 1, 6, refit_rows=refit_rows, block_rows=block_rows).toPandas()
    for k, y in SERIES.items():
        n = int(len(y) * 0.8)
        want = candidates(y, n, 1, 1, 6)
        p, q = min(want, key=lambda o: (want[o][2], *o))
        x = design(y, n, 1, 1, 6)
        ok = ~np.isnan(x).any(axis=1)
        known = {}

        def fits(t):
            end = n if t < n else n + (t - n) // refit_rows * refit_rows  # noqa: B023
            if end not in known:  # noqa: B023
                rows, cols = ok & (np.arange(len(y)) < end), [*range(p), *(1 + j for j in range(q))]  # noqa: B023
                known[end] = fit(x[rows][:, cols], y[rows])  # noqa: B023
            b = known[end]  # noqa: B023
            return b[0], b[1 : 1 + p], b[1 + p :]  # noqa: B023

        pred = recursion(y, fits, p)
        assert np.allclose(got[got.symbol == k].sort_values("ts")["pred"].to_numpy(), pred[n:], atol=1e-8)


def test_first_rows_have_no_forecast(spark):
    got = arma.walk_forward(panel(spark, {"s": SERIES["a22"]}, 0.0).withColumn("split", F.when(F.col("ts") >= 500, "train").otherwise("test")), "y", 2, 1, 6)
    first = [r.pred for r in got.orderBy("ts").limit(4).collect()]
    p = got.first().p
    assert [v is None for v in first] == [i < p for i in range(4)] and p > 0


def integrated(d, n=600, seed=5):
    y = simulate([0.3], [], n, seed, c=0.0)
    for _ in range(d):
        y = np.cumsum(y)
    return y


def test_differencing_order_and_forecasts_of_the_level(spark):
    series = {f"i{d}": integrated(d) for d in range(3)} | {"flat": np.full(60, 2.0), "line": np.arange(80.0)}
    got = {r.symbol: r.d for r in arma.difference_order(panel(spark, series), "y", maxlag=4, block_rows=200).collect()}
    assert got == {"i0": 0, "i1": 1, "i2": 2, "flat": 0, "line": 1}
    some = {k: series[k] for k in ("i0", "i1", "i2")}
    wf = arma.walk_forward(panel(spark, some), "y", 1, 1, 6, max_d=2).toPandas()
    for k, y in some.items():
        d, n = got[k], int(len(y) * 0.8)
        w = np.diff(y, d)
        want = candidates(w, n - d, 1, 1, 6)
        p, q = min(want, key=lambda o: (want[o][2], *o))
        b = want[p, q][3]
        pred = recursion(w, lambda t: (b[0], b[1 : 1 + p], b[1 + p :]), p)  # noqa: B023
        level = pred + (y[d:] - w)
        mine = wf[wf.symbol == k].sort_values("ts")
        assert set(mine.d) == {d} and np.allclose(mine["pred"].to_numpy(), level[n - d :], atol=1e-6) and np.allclose(mine["actual"], y[n:])


def test_prefix_scan_is_the_fold_of_all_before(spark):
    rows = [(s, 3 * i, i + 1) for s, n in (("a", 50), ("b", 1), ("c", 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "s string, at bigint, x bigint").repartition(6)
    for span in (1, 4, 1000):
        got = prefix_scan(df, ["s"], "at", ["x"], lambda a, b: (a[0] + b[0],), span)
        assert sorted((r.s, r.at, r.before_x) for r in got.collect()) == sorted((s, at, x * (x - 1) // 2 or None) for s, at, x in rows)
