"""Forecast jobs for all series at once.

Serving is a batch job: the latest feature row of every series is scaled with the
stored scaler table, scored with the coefficient table and turned into a price;
the backtest scores the last ``n`` rows of every series. Both are window + join
plans keyed by the series key - no per-series loop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.functions import metrics as M
from marketframe.operators import evaluate as ev, features as wn, linear, rows, scale
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
BACKTEST_ROWS = 60
BACKTEST_MIN_HISTORY = 70
PRICE_DIGITS = 4


def naive_prediction(df: DataFrame, today: str = "ret", target: str = "target") -> DataFrame:
    """ML-11: tomorrow = today."""
    return df.withColumns({"actual": F.col(target), "pred": F.col(today)})


def zero_prediction(df: DataFrame, target: str = "target") -> DataFrame:
    """ML-12: always predict a zero return."""
    return df.withColumns({"actual": F.col(target), "pred": F.lit(0.0)})


def next_step(frame: DataFrame, features: Sequence[str], coefs: DataFrame, scaler: DataFrame | None = None,
              spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """ML-14: next-step forecast per series - serving form (rows with complete
    features, target may be unknown) -> latest row -> scale by name -> score ->
    price. Output ``(keys..., ts, close, pred, pred_price, change_pct)``."""
    serving = frame.na.drop(subset=list(features))
    cols = list(dict.fromkeys([*spec.keys, *spec.order, *features, "close"]))
    latest = rows.latest_row(serving.select(*cols), spec).withColumn("__raw_close", F.col("close"))
    scaled = scale.transform_minmax(latest, features, scaler=scaler, keys=spec.keys) if scaler is not None else latest
    scored = linear.score_linear(scaled, coefs, features, spec.keys).withColumn("close", F.col("__raw_close"))
    out = linear.price_forecast(scored, "pred", "close", PRICE_DIGITS)
    return out.select(*spec.keys, spec.time, "close", "pred", "pred_price", "change_pct")


def backtest(frame: DataFrame, features: Sequence[str], coefs: DataFrame, spec: SeriesSpec = DEFAULT_SPEC,
             n: int = BACKTEST_ROWS, min_history: int = BACKTEST_MIN_HISTORY, aligned: bool = True,
             scaler: DataFrame | None = None) -> dict[str, DataFrame]:
    """ML-15: rolling backtest over the last ``n`` rows of every series with at least
    ``min_history`` rows. ``aligned=True`` compares the forecast of the next return
    with the next return; ``aligned=False`` reproduces the served numbers, which
    compare it with the same-day return. The price path uses the previous close in
    the slice times ``1 + forecast`` (first row: its own close).
    Returns ``rows`` (per-row predictions) and ``metrics`` (per series)."""
    serving = frame.na.drop(subset=list(features))
    # place and count in the order that the features were built in: one shuffle, one sort for all windows
    placed = serving.withColumns({"__pos": F.row_number().over(spec.window()), "__cnt": F.count(F.lit(1)).over(spec.whole())})
    tail = placed.filter((F.col("__cnt") >= min_history) & (F.col("__pos") > F.col("__cnt") - n)).drop("__pos", "__cnt")
    tail = tail.withColumn("__raw_close", F.col("close"))
    scored_in = scale.transform_minmax(tail, features, scaler=scaler, keys=spec.keys) if scaler is not None else tail
    scored = linear.score_linear(scored_in, coefs, features, spec.keys).withColumn("close", F.col("__raw_close"))
    actual = F.col("target") if aligned else F.col("ret")
    scored = scored.withColumn("actual", actual)
    scored = wn.projected_price(scored, "pred", spec)
    valid = F.col("actual").isNotNull() & F.col("pred").isNotNull()
    a, p = F.when(valid, F.col("actual")), F.when(valid, F.col("pred"))
    err = F.abs(F.col("close") - F.col("pred_price"))
    met = scored.groupBy(*spec.keys).agg(
        F.count_if(valid).alias("n"), M.rmse(a, p).alias("rmse"), M.mae(a, p).alias("mae"),
        M.directional_accuracy(a, p).alias("directional_accuracy"), F.avg(err).alias("price_mae"),
        (F.avg(err) * F.lit(ev.PIPS_PER_UNIT)).alias("mae_pips"))
    return {"rows": scored, "metrics": met.filter(F.col("n") > 0)}


def score_sequences(windows: DataFrame, model_fn: Callable[[np.ndarray], np.ndarray], window_col: str = "window",
                    out: str = "pred", fill: float = 0.0) -> DataFrame:
    """ML-16: score sequence windows (``ARRAY<ARRAY<DOUBLE>>``) with a user model in
    Arrow batches. ``model_fn`` maps a ``[batch, steps, features]`` array to
    ``[batch]`` predictions; rows without a full window get ``fill``. The model is
    captured once per task by the closure (use a broadcast variable for big ones)."""
    schema = T.StructType(windows.schema.fields + [T.StructField(out, T.DoubleType())])

    def run(it):
        for pdf in it:
            w = pdf[window_col]
            ok = w.notna().to_numpy()
            pred = np.full(len(pdf), fill, dtype=float)
            if ok.any():
                batch = np.stack([np.stack([np.asarray(s, dtype=float) for s in x]) for x in w[ok]])
                pred[ok] = np.asarray(model_fn(batch), dtype=float).reshape(-1)
            pdf = pdf.copy()
            pdf[out] = pred
            yield pdf

    return windows.mapInPandas(run, schema)


def in_sample_last(frame: DataFrame, features: Sequence[str], coefs: DataFrame, k: int,
                   spec: SeriesSpec = DEFAULT_SPEC, split_col: str = "split") -> DataFrame:
    """ML-10: in-sample predictions on the training split, last ``k`` rows, aligned
    to the last ``k`` actuals of the test slice with zero padding (JN-05)."""
    from marketframe.operators.joins import tail_align
    train = frame.filter(F.col(split_col) == "train")
    pred = rows.last_n(linear.score_linear(train, coefs, features, spec.keys), k, spec)
    actual = rows.last_n(frame.filter(F.col(split_col) == "test").withColumn("actual", F.col("target")), k, spec)
    return tail_align(actual, pred, spec)


def batch_to_pandas_model(weights: Sequence[float]) -> Callable[[np.ndarray], np.ndarray]:
    """A tiny example model for ML-16: weighted mean over time of the first feature."""
    w = np.asarray(weights, dtype=float)

    def fn(batch: np.ndarray) -> np.ndarray:
        return (batch[:, :, 0] * w).sum(axis=1) / w.sum()

    return fn


__all__ = ["naive_prediction", "zero_prediction", "next_step", "backtest", "score_sequences", "in_sample_last",
           "batch_to_pandas_model", "pd"]
