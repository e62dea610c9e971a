"""Series statistics.

Statistics are aggregates over groups (``by``), computed with partial
aggregation; per-group constants needed row-wise (mean, min/max) come back either
through the series window (same distribution as the features) or, for the
global case, as a scalar subquery - never through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.functions.columns import corr_safe
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
ACF_SIGNIFICANCE = 0.05
HISTOGRAM_BINS = 100
DESCRIBE_QUANTILES = (0.25, 0.5, 0.75)


def series_summary(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, price: str = "close") -> DataFrame:
    """AG-01: rows, first/last timestamp, min/max/current price per series."""
    return df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(spec.time).alias("first_ts"),
        F.max(spec.time).alias("last_ts"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.max_by(price, F.struct(*spec.order)).alias("current_price"),
    )


def null_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AG-02: NULL count per column (long form ``(by..., column, nulls)``) plus a
    ``__total__`` row."""
    wide = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    wide = wide.withColumn("__total__", sum((F.col(c) for c in cols), F.lit(0)))
    return wide.unpivot(list(by), [*cols, "__total__"], "column", "nulls")


def target_correlation(df: DataFrame, features: Sequence[str], target: str = "target",
                       by: Sequence[str] = ()) -> DataFrame:
    """AG-03: Pearson correlation of each feature with the target (pairwise complete,
    NULL for a constant column), long form with ``abs_corr`` and a rank by
    ``|corr|`` desc (ties by feature name)."""
    wide = df.groupBy(*by).agg(*[corr_safe(f, target).alias(f) for f in features])
    long = wide.unpivot(list(by), list(features), "feature", "corr")
    from pyspark.sql import Window
    w = Window.partitionBy(*by).orderBy(F.abs("corr").desc_nulls_last(), F.col("feature"))
    return long.withColumns({"abs_corr": F.abs("corr"), "rank": F.row_number().over(w).cast("bigint")})


def correlation_matrix(df: DataFrame, features: Sequence[str], by: Sequence[str] = (),
                       complete: bool = False) -> DataFrame:
    """AG-04: all k(k-1)/2 pairwise correlations, long form
    ``(by..., feature_a, feature_b, corr)`` with ``feature_a`` before ``feature_b``
    in the given order; NULL for a constant column.

    Default: pairwise-complete, one aggregate per pair (pandas semantics with NULLs).
    ``complete=True`` (rows known to have no NULLs, e.g. a training frame) reads
    every pair off one Gram row per group - the fast path for wide sets."""
    feats = list(features)
    if complete:
        from marketframe.operators.linear import gram
        m = len(feats)
        g = gram(df, feats[:-1], feats[-1], by)

        def at(i: int, j: int) -> int:
            return i * m - i * (i - 1) // 2 + (j - i)

        # one literal table of pairs and places, and one expression for all of them
        places = F.array(*[F.struct(F.lit(feats[i]).alias("feature_a"), F.lit(feats[j]).alias("feature_b"),
                                    F.lit(at(i, i)).alias("ii"), F.lit(at(j, j)).alias("jj"), F.lit(at(i, j)).alias("ij"))
                           for i in range(m) for j in range(i + 1, m)])
        p = g.select(*by, "cm", F.inline(places))
        cm = F.col("cm")
        den = F.sqrt(F.get(cm, F.col("ii")) * F.get(cm, F.col("jj")))
        return p.select(*by, "feature_a", "feature_b", F.when(den > 0, F.get(cm, F.col("ij")) / den).alias("corr"))
    pairs = [(a, b) for i, a in enumerate(feats) for b in feats[i + 1:]]
    names = [f"{a}|{b}" for a, b in pairs]
    wide = df.groupBy(*by).agg(*[corr_safe(a, b).alias(n) for (a, b), n in zip(pairs, names)])
    long = wide.unpivot(list(by), names, "pair", "corr")
    return long.select(*by, F.split("pair", r"\|", 2)[0].alias("feature_a"),
                       F.split("pair", r"\|", 2)[1].alias("feature_b"), "corr")


def autocorrelation(df: DataFrame, col: str, nlags: int, spec: SeriesSpec = DEFAULT_SPEC,
                    threshold: float = ACF_SIGNIFICANCE) -> DataFrame:
    """AG-05: biased sample ACF per series for lags 1..nlags,
    ``sum_t d_t d_{t-k} / sum_t d_t^2`` with ``d = x - mean(x)``; long form with a
    significance flag ``|acf| > threshold``."""
    d = df.filter(F.col(col).isNotNull())
    d = d.withColumn("__d", F.col(col) - F.avg(col).over(spec.whole()))
    w = spec.window()
    d = d.withColumns({f"__l{k}": F.lag("__d", k).over(w) for k in range(1, nlags + 1)})
    den = F.sum(F.col("__d") * F.col("__d"))
    wide = d.groupBy(*spec.keys).agg(
        *[F.try_divide(F.coalesce(F.sum(F.col("__d") * F.col(f"__l{k}")), F.lit(0.0)), den).alias(str(k))
          for k in range(1, nlags + 1)])
    long = wide.unpivot(list(spec.keys), [str(k) for k in range(1, nlags + 1)], "lag", "acf")
    return long.withColumns({"lag": F.col("lag").cast("bigint"),
                             "significant": F.abs("acf") > F.lit(threshold)})


def partial_autocorrelation(acf_long: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """AG-06: PACF by the Durbin-Levinson recursion on each series' ACF vector.

    The input is the (small) AG-05 long table - ``nlags`` rows per series - so each
    group handed to pandas is bounded by ``nlags``, never by the series length.
    """
    import numpy as np
    import pandas as pd

    key_list = list(keys)
    schema = acf_long.select(*key_list).schema.simpleString()[len("struct<"):-1]
    out_schema = f"{schema},lag bigint,pacf double"

    def dl(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = np.concatenate([[1.0], pdf["acf"].to_numpy(dtype=float)])
        L = len(r) - 1
        pac = np.full(L, np.nan)
        phi_prev = np.zeros(0)
        v = 1.0
        for k in range(1, L + 1):
            if k == 1:
                phi_kk = r[1]
            else:
                phi_kk = (r[k] - np.dot(phi_prev, r[k - 1:0:-1])) / v if v != 0 else np.nan
            phi = np.concatenate([phi_prev - phi_kk * phi_prev[::-1], [phi_kk]])
            v = v * (1 - phi_kk * phi_kk)
            pac[k - 1] = phi_kk
            phi_prev = phi
        res = pd.DataFrame({"lag": np.arange(1, L + 1, dtype="int64"), "pacf": pac})
        for k in key_list:
            res.insert(0, k, pdf[k].iloc[0])
        return res[key_list + ["lag", "pacf"]]

    return acf_long.select(*key_list, "lag", "acf").groupBy(*key_list).applyInPandas(dl, out_schema)


def histogram(df: DataFrame, col: str, bins: int = HISTOGRAM_BINS, by: Sequence[str] = ()) -> DataFrame:
    """AG-07: equal-width histogram between the group min and max (the max falls in
    the last bin; a constant group lands in the middle bin). Long form of the
    non-empty bins ``(by..., bin, bin_lo, bin_hi, n)``."""
    d = df.filter(F.col(col).isNotNull())
    if by:
        # bounds as a partial aggregate (one row per group) joined back by key - a
        # window over the group would put a hot group into a single task
        bounds = d.groupBy(*by).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
        d = d.join(bounds, list(by))
    else:
        bounds = d.select(F.min(col).alias("lo"), F.max(col).alias("hi"))
        d = d.withColumns({"__lo": bounds.select("lo").scalar(), "__hi": bounds.select("hi").scalar()})
    const = F.col("__hi") == F.col("__lo")
    lo = F.when(const, F.col("__lo") - 0.5).otherwise(F.col("__lo"))
    hi = F.when(const, F.col("__hi") + 0.5).otherwise(F.col("__hi"))
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("bigint")
    d = d.withColumns({"bin": idx, "__blo": lo, "__w": width})
    out = d.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.first("__blo").alias("__blo"),
                                    F.first("__w").alias("__w"))
    return out.select(*by, "bin", (F.col("__blo") + F.col("bin") * F.col("__w")).alias("bin_lo"),
                      (F.col("__blo") + (F.col("bin") + 1) * F.col("__w")).alias("bin_hi"), "n")


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False,
             accuracy: int = 100000, select: bool = False) -> DataFrame:
    """AG-08: count, mean, sample std, min, quartiles, max per column (long form).

    The exact ``percentile`` (linear interpolation, equal to pandas) buffers a group's distinct values: the choice for many small
    groups. ``select=True`` finds the same values by rank selection (:mod:`quantiles`), for groups of any size. ``approx=True`` uses the
    mergeable ``percentile_approx`` sketch, with memory per group bounded by ``accuracy``.
    """
    if select:
        from marketframe.operators.layout import join_null_safe
        from marketframe.operators.quantiles import exact_quantiles

        aggs = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                         F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c) for c in cols]
        rest = df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*[F.col(c) for c in cols])))
        q = exact_quantiles(df, cols, DESCRIBE_QUANTILES, by)
        out = join_null_safe(rest.where("count > 0"), q, [*by, "column"]).unionByName(rest.where("count = 0"), allowMissingColumns=True)
        p = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
        return out.select(*by, "column", "count", "mean", "std", "min", *p, "max")
    qs = list(DESCRIBE_QUANTILES)
    aggs = []
    for c in cols:
        q = (F.percentile_approx(c, qs, accuracy) if approx else F.percentile(c, F.array(*[F.lit(x) for x in qs])))
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            q[0].cast("double").alias("p25"), q[1].cast("double").alias("p50"), q[2].cast("double").alias("p75"),
            F.max(c).cast("double").alias("max")).alias(c))
    wide = df.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select(*by, "s.*")
