"""Exclusive prefix scans over small rows: what stands before each block of a series.

``combine`` is associative (merged co-moments, composed affine maps, ...). The scan is two-level: blocks are folded in
groups of ``span`` consecutive positions, the groups' totals are scanned per series, and each group is scanned from its carry. A task
holds ``span`` blocks or one row a group, never all blocks of a long series; the order of the folds is fixed, so
reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.session import checkpoint


def prefix_scan(rows: DataFrame, by: Sequence[str], at: str, payload: Sequence[str], combine: Callable[[tuple, tuple], tuple],
                span: int = 512) -> DataFrame:
    """``rows`` (one per ``by`` and ``at``) with ``before_<c>`` for each payload column: the fold of all
    rows of the series with a smaller ``at``, NULL for the first."""
    by, payload = list(by), list(payload)
    rows = checkpoint(rows).withColumn("__g", F.floor(F.col(at) / F.lit(span)).cast("bigint"))  # read twice
    total_schema = T.StructType([rows.schema[c] for c in [*by, "__g", *payload]])
    before = [T.StructField(f"before_{c}", rows.schema[c].dataType) for c in payload]

    def values(pdf: pd.DataFrame) -> list[tuple]:
        return list(pdf[payload].itertuples(index=False, name=None))

    def frame(records: list[tuple], schema: T.StructType) -> pd.DataFrame:
        return pd.DataFrame(records, columns=schema.names, dtype=object)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        key = tuple(pdf[c].iloc[0] for c in [*by, "__g"])
        return frame([key + reduce(combine, values(pdf.sort_values(at)))], total_schema)

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__g")
        out, acc = [], None
        for key, value in zip(pdf[[*by, "__g"]].itertuples(index=False, name=None), values(pdf), strict=True):
            if acc is not None:
                out.append(key + acc)
            acc = value if acc is None else combine(acc, value)
        return frame(out, total_schema)

    carried = rows.groupBy(*by, "__g").applyInPandas(total, total_schema).groupBy(*by).applyInPandas(carry, total_schema)
    both = rows.withColumn("__carry", F.lit(False)).unionByName(carried.withColumn("__carry", F.lit(True)), allowMissingColumns=True)
    own = [c for c in rows.columns if c != "__g"]
    schema = T.StructType([rows.schema[c] for c in own] + before)

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        seed = pdf["__carry"].astype(bool)
        acc = values(pdf[seed])[0] if seed.any() else None
        out = []
        pdf = pdf[~seed].sort_values(at)
        for row, value in zip(pdf[own].astype(object).itertuples(index=False, name=None), values(pdf), strict=True):
            out.append(row + (acc or (None,) * len(payload)))
            acc = value if acc is None else combine(acc, value)
        return frame(out, schema)

    return both.groupBy(*by, "__g").applyInPandas(within, schema)
