"""Training-pipeline compositions (load -> clean -> features -> split -> scale), one
lazy DAG; the series key is the only shuffle key from features to metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.operators import clean, features as wn, rows
from marketframe.sources import panels
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# feature sets used on the driver panels (ticks are short: ~45-99 rows per series)
TICK_MAS = (5, 10)
TICK_LAGS = (1, 2, 3, 5)
TICK_FEATURES = ["ret", "ma_5", "ma_10", "lag_1", "lag_2", "lag_3", "lag_5"]


def tick_features(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Return, short moving averages, lagged returns and the next-return target."""
    out = wn.returns(df, spec)
    out = wn.moving_averages(out, TICK_MAS, spec)
    out = wn.lags(out, TICK_LAGS, spec)
    return wn.next_target(out, spec)


def tick_training_frame(spark: SparkSession, sf_dir: str, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """ticks -> PF-05 -> features -> drop incomplete rows -> 80/20 split per series."""
    t = clean.positive_prices(panels.ticks(spark, sf_dir, positive_only=False))
    f = wn.training_rows(tick_features(t, spec), TICK_FEATURES)
    return rows.split_fraction(f, spec)


def bar_features(spark: SparkSession, sf_dir: str, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """bars_1h -> PF-05 -> extended feature set (WN-19)."""
    b = clean.positive_prices(panels.bars_1h(spark, sf_dir))
    return wn.extended_features(b, spec)


def bar_training_frame(spark: SparkSession, sf_dir: str, feature_cols: Sequence[str] = tuple(wn.EXTENDED_FEATURES),
                       spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Extended bar features, incomplete rows dropped, unscaled copies kept, 80/20 split."""
    f = wn.training_rows(bar_features(spark, sf_dir, spec), feature_cols)
    f = clean.keep_unscaled(f, ("ret", "close"))
    return rows.split_fraction(f, spec)
