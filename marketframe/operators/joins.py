"""Key joins and set operations.

All joins are equi-joins on ``(symbol, ts)`` or on small-table keys; Spark picks
sort-merge or (with AQE, at runtime, below the broadcast threshold) broadcast.
Explicit ``broadcast`` hints are used only on literal tables (alias order, feature
names) and single rows; for tables that grow with the data Spark decides at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.spec import DEFAULT_SPEC, SeriesSpec


def align_to_prices(features: DataFrame, prices: DataFrame, keys: Sequence[str] = ("symbol", "ts"),
                    price_cols: Sequence[str] = ("close",)) -> DataFrame:
    """JN-01: attach raw prices to feature rows by key (inner join)."""
    right = prices.select(*keys, *[F.col(c).alias(f"raw_{c}") for c in price_cols])
    return features.join(right, list(keys), "inner")


def unmatched(features: DataFrame, prices: DataFrame, keys: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """JN-01 check: feature rows whose key has no price row (must be empty)."""
    return features.join(prices.select(*keys), list(keys), "left_anti")


def intersect_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """JN-02: rows of ``left`` whose key also exists in ``right`` (left semi join)."""
    return left.join(right.select(*keys), list(keys), "left_semi")


def attach_predictions(rows: DataFrame, preds: DataFrame, keys: Sequence[str] = ("symbol", "ts"),
                       how: str = "inner") -> DataFrame:
    """JN-04: predictions joined to their rows by key, never by position."""
    return rows.join(preds, list(keys), how)


def tail_align(actual: DataFrame, pred: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, actual_col: str = "actual",
               pred_col: str = "pred", pad: float = 0.0) -> DataFrame:
    """JN-05: align two per-series vectors of unequal length from the end.

    Rows are numbered from the last one (``rn_desc``); the actual side is kept in
    full and a missing prediction is padded with ``pad`` (left padding).
    """
    w = spec.window_desc()
    a = actual.select(*spec.keys, *spec.order, actual_col).withColumn("rn_desc", F.row_number().over(w))
    wp = Window.partitionBy(*spec.keys).orderBy(*[F.col(c).desc() for c in spec.order])
    p = pred.select(*spec.keys, F.col(pred_col).alias("__p"), F.row_number().over(wp).alias("rn_desc"))
    out = a.join(p, [*spec.keys, "rn_desc"], "left")
    return out.withColumn(pred_col, F.coalesce(F.col("__p"), F.lit(pad))).drop("__p")


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """JN-10: union by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
