"""Min-max scaling fitted on the training split only.

The scaler is a *table* ``(keys..., feature, min, max)``, never a pickled object.
Fit-and-transform in one job uses windows over the series distribution (no join,
no extra shuffle); applying a stored scaler joins it by key and scales **by
column name**, so a model's feature list can never be silently left unscaled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _range(lo: Column, hi: Column) -> Column:
    # sklearn replaces a zero data range by 1, so a constant column scales to 0
    return F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)


def fit_minmax(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("symbol",),
               split_col: str = "split", fit_on: str = "train") -> DataFrame:
    """FS-01: long scaler table ``(keys..., feature, min, max)`` from training rows."""
    src = df.filter(F.col(split_col) == fit_on) if split_col in df.columns else df
    aggs = [F.struct(F.lit(f).alias("feature"), F.min(f).cast("double").alias("min"),
                     F.max(f).cast("double").alias("max")).alias(f) for f in features]
    wide = src.groupBy(*keys).agg(*aggs)
    return wide.select(*keys, F.explode(F.array(*[F.col(f) for f in features])).alias("s")).select(*keys, "s.*")


def transform_minmax(df: DataFrame, features: Sequence[str], scaler: DataFrame | None = None,
                     keys: Sequence[str] = ("symbol",), split_col: str = "split",
                     fit_on: str = "train") -> DataFrame:
    """FS-02: ``(x - min) / range``; test values may leave [0, 1] (no clipping).

    Without ``scaler`` the fit happens in the same pass via a window over ``keys``
    restricted to training rows. With a stored ``scaler`` table the parameters are
    pivoted to one row per key and joined by key (AQE broadcasts it when small).
    """
    if scaler is None:
        w = Window.partitionBy(*keys)
        is_fit = F.col(split_col) == fit_on if split_col in df.columns else F.lit(True)
        cols = {}
        for f in features:
            lo = F.min(F.when(is_fit, F.col(f))).over(w)
            hi = F.max(F.when(is_fit, F.col(f))).over(w)
            cols[f] = (F.col(f) - lo) / _range(lo, hi)
        return df.withColumns(cols)
    params = _wide_params(scaler, features, keys)
    joined = df.join(params, list(keys), "left")
    cols = {f: (F.col(f) - F.col(f"__min_{f}")) / _range(F.col(f"__min_{f}"), F.col(f"__max_{f}")) for f in features}
    return joined.withColumns(cols).drop(*[f"__min_{f}" for f in features], *[f"__max_{f}" for f in features])


def inverse_minmax(df: DataFrame, features: Sequence[str], scaler: DataFrame,
                   keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """FS-03: ``x * range + min`` with the same zero-range rule as the transform."""
    params = _wide_params(scaler, features, keys)
    joined = df.join(params, list(keys), "left")
    cols = {f: F.col(f) * _range(F.col(f"__min_{f}"), F.col(f"__max_{f}")) + F.col(f"__min_{f}") for f in features}
    return joined.withColumns(cols).drop(*[f"__min_{f}" for f in features], *[f"__max_{f}" for f in features])


def _wide_params(scaler: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    wanted = scaler.filter(F.col("feature").isin(list(features)))
    aggs = []
    for f in features:
        aggs.append(F.max(F.when(F.col("feature") == f, F.col("min"))).alias(f"__min_{f}"))
        aggs.append(F.max(F.when(F.col("feature") == f, F.col("max"))).alias(f"__max_{f}"))
    return wanted.groupBy(*keys).agg(*aggs)


def missing_scaler_features(scaler: DataFrame, features: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Model features without scaler parameters, per key (the train/serve skew check)."""
    wide = scaler.groupBy(*keys).agg(*[F.count_if(F.col("feature") == f).alias(f) for f in features])
    long = wide.unpivot(list(keys), list(features), "feature", "__n")
    return long.filter(F.col("__n") == 0).drop("__n")
