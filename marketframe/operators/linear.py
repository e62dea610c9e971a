"""Linear forecasting per series from mergeable Gram aggregates (SURVEY §2.8,
ML-01..ML-07, ML-17).

A fit never collects rows. Each group ``(by...)`` is reduced by one hash
aggregate to ``n``, the means and the centred co-moment matrix of
``z = [features..., target]`` (``covar_pop * n``; Spark's online co-moment
update is numerically stable and partially aggregated map-side). The tiny
``(k+1)²`` solve happens per group in pandas. Blocks of a series merge with
the parallel co-moment formula, so expanding time-series folds, the ridge
grid, ablations and out-of-sample scores all come from per-block Gram rows;
the MSE of a test block is computed from its own Gram row
(``wᵀ C w + n (w·m - b0)²``) without another pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
RIDGE_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
N_SPLITS = 5


# ------------------------------------------------------------------ Gram rows
MERGE_FANOUT = 512  # first-level merge groups per key
PARTIALS_HELD = 4096  # keys whose partials a task holds before it passes them on


def gram(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str]) -> DataFrame:
    """One row per group: ``n``, ``mean`` (k+1) and upper-triangular centred
    co-moments ``cm`` ((k+1)(k+2)/2) of ``[features..., target]``; rows with a NULL
    in any of them are skipped (training form). ``by=()`` is one group; a group
    without rows has no Gram row.

    Any width goes one way: each task reduces its rows per key to partials
    ``(n, mean, C)`` with one BLAS product per batch, and partials merge in two
    levels, so a key present in every input partition (a hot series, or the global
    case) never sends one partial per input partition to a single task."""
    z, keys = list(features) + [target], list(by) or ["__all"]
    d = df.na.drop(subset=z)
    if not by:
        d = d.withColumn("__all", F.lit(0))
    m = len(z)
    iu = np.triu_indices(m)
    schema = T.StructType([d.schema[c] for c in keys] + [
        T.StructField("n", T.LongType()), T.StructField("mean", T.ArrayType(T.DoubleType())),
        T.StructField("cm", T.ArrayType(T.DoubleType()))])
    cols = keys + ["n", "mean", "cm"]

    def rows_of(acc: dict) -> pd.DataFrame:
        return pd.DataFrame([[*k, n, mu.tolist(), c[iu].tolist()] for k, (n, mu, c) in acc.items()], columns=cols)

    def partial(it):
        acc: dict = {}
        for pdf in it:
            for key, g in pdf.groupby(keys, sort=False, dropna=False):
                x = g[z].to_numpy(dtype=float)
                mu = x.mean(axis=0)
                xc = x - mu
                part = (len(x), mu, xc.T @ xc)
                acc[key] = _merge([acc[key], part]) if key in acc else part
                if len(acc) > PARTIALS_HELD:
                    yield rows_of(acc)
                    acc.clear()
        yield rows_of(acc)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return rows_of({tuple(pdf[b].iloc[0] for b in keys): _merge(_row_parts(pdf, m))})

    parts = d.select(*keys, *z).mapInPandas(partial, schema)
    salted = parts.withColumn("__salt", F.spark_partition_id() % F.lit(MERGE_FANOUT))
    out = salted.groupBy(*keys, "__salt").applyInPandas(merge, schema).groupBy(*keys).applyInPandas(merge, schema)
    return out if by else out.drop("__all")


def _full(cm: np.ndarray, m: int) -> np.ndarray:
    a = np.zeros((m, m))
    iu = np.triu_indices(m)
    a[iu] = cm
    return a + np.triu(a, 1).T


def _merge(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Parallel co-moment merge of ``(n, mean, C)`` parts."""
    n, mean, c = 0, None, None
    for nb, mb, cb in parts:
        if nb == 0:
            continue
        if n == 0:
            n, mean, c = nb, mb.copy(), cb.copy()
            continue
        tot = n + nb
        delta = mb - mean
        c = c + cb + np.outer(delta, delta) * (n * nb / tot)
        mean = mean + delta * (nb / tot)
        n = tot
    return n, mean, c


def _solve(n: int, mean: np.ndarray, c: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Ridge (alpha>0) or min-norm OLS (alpha=0) with intercept from a centred Gram."""
    k = len(mean) - 1
    cxx, cxy = c[:k, :k], c[:k, k]
    d = np.sqrt(np.clip(np.diag(cxx), 0, None))
    d[d == 0] = 1.0
    a = (cxx + alpha * np.eye(k)) / np.outer(d, d)
    if not np.isfinite(a).all():
        return float("nan"), np.full(k, np.nan)
    gamma = np.linalg.lstsq(a, cxy / d, rcond=None)[0]
    beta = gamma / d
    b0 = mean[k] - mean[:k] @ beta
    return float(b0), beta


def _sse(n: int, mean: np.ndarray, c: np.ndarray, b0: float, beta: np.ndarray) -> float:
    w = np.append(-beta, 1.0)
    return float(max(w @ c @ w, 0.0) + n * (w @ mean - b0) ** 2)


def _row_parts(pdf: pd.DataFrame, m: int):
    return [(int(r.n), np.asarray(r.mean, float), _full(np.asarray(r.cm, float), m)) for r in pdf.itertuples()]


def _key_schema(df: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in by]


# ------------------------------------------------------------------ fitting
COEF_FIELDS = [T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType()),
               T.StructField("coef", T.ArrayType(T.DoubleType()))]


def fit_linear(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ("symbol",),
               alpha: float = 0.0) -> DataFrame:
    """ML-01 (alpha=0, OLS) / ML-02 (ridge with sklearn's unnormalised penalty):
    coefficient table ``(by..., n, intercept, coef ARRAY<DOUBLE>)`` in feature order."""
    g = gram(df, features, target, by)
    return solve_gram(g, len(features), by, alpha)


def solve_gram(g: DataFrame, k: int, by: Sequence[str], alpha: float = 0.0) -> DataFrame:
    by_l = list(by)
    schema = T.StructType(_key_schema(g, by_l) + COEF_FIELDS)
    m = k + 1

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                n = int(r.n)
                b0, beta = _solve(n, np.asarray(r.mean, float), _full(np.asarray(r.cm, float), m), alpha)
                out.append([getattr(r, c) for c in by_l] + [n, b0, beta.tolist()])
            yield pd.DataFrame(out, columns=by_l + ["n", "intercept", "coef"])

    # each row is one group's Gram: mapInPandas keeps the solve per partition, no shuffle
    return g.mapInPandas(run, schema)


def coefficients_long(coefs: DataFrame, features: Sequence[str], by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Long form ``(by..., feature, coefficient)``."""
    names = F.array(*[F.lit(f) for f in features])
    z = F.arrays_zip(names.alias("feature"), F.col("coef").alias("coefficient"))
    return coefs.select(*by, F.inline(z))


def importance(coefs: DataFrame, features: Sequence[str], by: Sequence[str] = ("symbol",)) -> DataFrame:
    """ML-06: coefficient table with ``abs_coefficient``, rank by |coef| and sign label."""
    from pyspark.sql import Window
    long = coefficients_long(coefs, features, by)
    w = Window.partitionBy(*by).orderBy(F.abs("coefficient").desc(), F.col("feature"))
    return long.withColumns({
        "abs_coefficient": F.abs("coefficient"),
        "rank": F.row_number().over(w).cast("bigint"),
        "direction": F.when(F.col("coefficient") > 0, F.lit("positive")).otherwise(F.lit("negative")),
    })


def score_linear(df: DataFrame, coefs: DataFrame, features: Sequence[str], by: Sequence[str] = ("symbol",),
                 out: str = "pred") -> DataFrame:
    """ML-05: ``intercept + Σ coef_i x_i`` after joining the coefficient table by key
    (one row per key; without keys one row). Spark picks the join by the table's size at run time."""
    params = coefs.select(*by, F.col("intercept").alias("__b0"), F.col("coef").alias("__b"))
    j = df.join(params, list(by), "left") if by else df.crossJoin(F.broadcast(params))
    expr: Column = F.col("__b0")
    for i, f in enumerate(features):
        expr = expr + F.col("__b")[i] * F.col(f)
    return j.withColumn(out, expr).drop("__b0", "__b")


# ------------------------------------------------------------------ folds & grid
def fold_blocks(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, n_splits: int = N_SPLITS,
                out: str = "block") -> DataFrame:
    """ML-03: expanding time-series folds. With ``t = n // (n_splits+1)``, block 0 holds
    the first ``n - n_splits*t`` rows (it absorbs the remainder) and blocks
    1..n_splits hold ``t`` rows each; fold i trains on blocks < i and tests on block i."""
    pos = F.row_number().over(spec.window()) - 1
    n = F.count(F.lit(1)).over(spec.whole())
    t = F.floor(n / F.lit(n_splits + 1))
    first = n - F.lit(n_splits) * t
    blk = F.when(pos < first, F.lit(0)).otherwise(F.lit(1) + F.floor((pos - first) / t))
    return df.withColumn(out, F.when(t > 0, blk).cast("int"))


def ridge_grid(df: DataFrame, features: Sequence[str], target: str, spec: SeriesSpec = DEFAULT_SPEC,
               alphas: Sequence[float] = RIDGE_ALPHAS, n_splits: int = N_SPLITS) -> dict[str, DataFrame]:
    """ML-04: time-series CV grid over ``alphas`` scored by MSE (first best wins),
    refit on all rows with the best alpha. Returns ``scores`` (by, fold, alpha, mse),
    ``best`` (by, alpha, cv_mse) and ``coefs`` of the refit."""
    by = list(spec.keys)
    blocks = fold_blocks(df, spec, n_splits)
    g = gram(blocks, features, target, by + ["block"])
    m = len(features) + 1
    key_fields = _key_schema(g, by)
    score_schema = T.StructType(key_fields + [T.StructField("fold", T.LongType()), T.StructField("alpha", T.DoubleType()),
                                              T.StructField("mse", T.DoubleType())])
    al = [float(a) for a in alphas]

    def grid(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        parts = {int(r.block): p for r, p in zip(pdf.itertuples(), _row_parts(pdf, m))}
        rows = []
        for fold in range(1, n_splits + 1):
            if fold not in parts:
                continue
            tr = _merge([parts[b] for b in range(fold) if b in parts])
            if tr[0] == 0:
                continue
            nt, mt, ct = parts[fold]
            for a in al:
                b0, beta = _solve(*tr, a)
                rows.append([fold, a, _sse(nt, mt, ct, b0, beta) / nt])
        res = pd.DataFrame(rows, columns=["fold", "alpha", "mse"])
        for c in reversed(by):
            res.insert(0, c, pdf[c].iloc[0])
        return res

    scores = g.groupBy(*by).applyInPandas(grid, score_schema)
    cv = scores.groupBy(*by, "alpha").agg(F.avg("mse").alias("cv_mse"))
    order = {a: i for i, a in enumerate(al)}
    idx = F.create_map(*[x for a, i in order.items() for x in (F.lit(a), F.lit(i))])
    best = cv.groupBy(*by).agg(F.min_by(F.struct("alpha", "cv_mse"), F.struct("cv_mse", idx[F.col("alpha")])).alias(
        "b")).select(*by, "b.alpha", "b.cv_mse")
    coefs = refit(g, best, len(features), by)
    return {"scores": scores, "best": best, "coefs": coefs}


def refit(block_gram: DataFrame, best: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """Merge all blocks of a group and solve with the group's chosen alpha."""
    by_l = list(by)
    m = k + 1
    j = block_gram.join(best.select(*by_l, "alpha"), by_l)
    schema = T.StructType(_key_schema(block_gram, by_l) + [T.StructField("alpha", T.DoubleType())] + COEF_FIELDS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, c = _merge(_row_parts(pdf, m))
        a = float(pdf["alpha"].iloc[0])
        b0, beta = _solve(n, mean, c, a)
        res = pd.DataFrame([[a, n, b0, beta.tolist()]], columns=["alpha", "n", "intercept", "coef"])
        for col in reversed(by_l):
            res.insert(0, col, pdf[col].iloc[0])
        return res

    return j.groupBy(*by_l).applyInPandas(run, schema)


def evaluate_subsets(train: DataFrame, test: DataFrame, subsets: Mapping[str, Sequence[str]], features: Sequence[str],
                     target: str, by: Sequence[str] = ("symbol",), alpha: float = 0.0) -> DataFrame:
    """ML-17 ablation: fit every feature subset from one shared training Gram (its
    sub-matrix) and score each on the test Gram: ``(by..., subset, n_features, mse,
    rmse)``. One pass over train and one over test, whatever the number of subsets."""
    by_l = list(by)
    feats = list(features)
    m = len(feats) + 1
    gtr = gram(train, feats, target, by_l).withColumn("role", F.lit("train"))
    gte = gram(test, feats, target, by_l).withColumn("role", F.lit("test"))
    both = gtr.unionByName(gte)
    idx = {name: [feats.index(f) for f in cols] for name, cols in subsets.items()}
    schema = T.StructType(_key_schema(both, by_l) + [T.StructField("subset", T.StringType()),
                                                     T.StructField("n_features", T.LongType()),
                                                     T.StructField("mse", T.DoubleType()),
                                                     T.StructField("rmse", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {r.role: p for r, p in zip(pdf.itertuples(), _row_parts(pdf, m))}
        rows = []
        if "train" in parts and "test" in parts:
            (n1, m1, c1), (n2, m2, c2) = parts["train"], parts["test"]
            for name, ix in idx.items():
                sel = ix + [m - 1]
                b0, beta = _solve(n1, m1[sel], c1[np.ix_(sel, sel)], alpha)
                mse = _sse(n2, m2[sel], c2[np.ix_(sel, sel)], b0, beta) / n2
                rows.append([name, len(ix), mse, float(np.sqrt(mse))])
        res = pd.DataFrame(rows, columns=["subset", "n_features", "mse", "rmse"])
        for c in reversed(by_l):
            res.insert(0, c, pdf[c].iloc[0])
        return res

    return both.groupBy(*by_l).applyInPandas(run, schema)


# ------------------------------------------------------------------ horizons
def horizon_frame(df: DataFrame, horizons: Sequence[int], spec: SeriesSpec = DEFAULT_SPEC, col: str = "close",
                  within: str | None = "split") -> DataFrame:
    """ML-07 design: one row per (row, horizon) with the forward return
    ``target_h = close_{t+h}/close_t - 1`` (never crossing ``within``)."""
    from marketframe.operators.features import forward_returns
    f = forward_returns(df, horizons, spec, col, within)
    arr = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"fwd_ret_{h}").alias("target_h")) for h in horizons])
    out = f.withColumn("__hz", F.explode(arr))
    return out.select(*[c for c in f.columns if not c.startswith("fwd_ret_")], "__hz.h", "__hz.target_h")


def price_forecast(df: DataFrame, pred: str = "pred", price: str = "close", digits: int = 4) -> DataFrame:
    """ML-13: predicted price ``P_t (1 + r̂)`` and change in percent, both rounded."""
    return df.withColumns({
        "pred_price": F.round(F.col(price) * (F.lit(1.0) + F.col(pred)), digits),
        "change_pct": F.round(F.col(pred) * F.lit(100.0), digits),
    })
