"""Data-quality and leakage audits. Each returns a flag table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# Fixed values that must equal the reference for equal results.
LEAK_SIGNED = 0.95      # feature-target correlation above this is leakage
LEAK_ABS = 0.7          # |corr| flagged on the training frame
LEAK_ABS_TEST = 0.5     # |corr| flagged on the test frame
LOW_SIGNAL = 0.05       # |corr| below this carries no signal
DA_SUSPICIOUS = 0.65
SHARPE_SUSPICIOUS = 3.0
CORR_TODAY_SUSPICIOUS = 0.5
STD_RATIO_SUSPICIOUS = 0.8
DA_GAP_TEST_BETTER = -0.05
DA_GAP_OVERFIT = 0.10
R2_GAP_GOOD = 0.05
R2_GAP_MILD = 0.1
MAE_RATIO_LOW, MAE_RATIO_HIGH = 0.9, 1.1
GOOD_MODEL_DA = 0.52
TIER_SUSPICIOUS_DA = 0.70
TIER_GOOD_DA = 0.60
BACKTEST_MIN_ROWS = 70    # 60-row backtest + 10 rows of history
TRAINING_MIN_ROWS = 250


def correlation_flags(corr_table: DataFrame, corr_col: str = "corr") -> DataFrame:
    """AU-01: leakage/low-signal flags on an AG-03 table ``(..., feature, corr)``."""
    c = F.col(corr_col)
    return corr_table.withColumns({
        "leak_signed": c > F.lit(LEAK_SIGNED),
        "leak_abs": F.abs(c) > F.lit(LEAK_ABS),
        "leak_abs_test": F.abs(c) > F.lit(LEAK_ABS_TEST),
        "meaningful": F.abs(c) > F.lit(LOW_SIGNAL),
    })


def low_signal_summary(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AU-01: count of meaningful features (|corr| > 0.05) and of leak flags."""
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("meaningful").alias("meaningful"),
        F.count_if("leak_signed").alias("leak_signed"),
        F.count_if("leak_abs").alias("leak_abs"),
    ).withColumn("too_few_meaningful", F.col("meaningful") < F.lit(5))


def contamination(df: DataFrame, keys: Sequence[str] = ("symbol", "ts"), split_col: str = "split") -> DataFrame:
    """AU-02: keys present in both the train and the test split (must be 0)."""
    tr = df.filter(F.col(split_col) == "train").select(*keys)
    te = df.filter(F.col(split_col) == "test").select(*keys)
    both = tr.intersect(te)
    return both.agg(F.count(F.lit(1)).alias("overlapping_keys")).withColumn(
        "clean", F.col("overlapping_keys") == 0)


def too_good_flags(metrics: DataFrame) -> DataFrame:
    """AU-03: flags on a metrics table with ``directional_accuracy``, ``sharpe_ratio``
    and optionally ``corr_today`` / ``std_ratio``."""
    cols = {
        "da_suspicious": F.col("directional_accuracy") > F.lit(DA_SUSPICIOUS),
        "sharpe_suspicious": F.col("sharpe_ratio") > F.lit(SHARPE_SUSPICIOUS),
    }
    if "corr_today" in metrics.columns:
        cols["predicts_today"] = F.col("corr_today") > F.lit(CORR_TODAY_SUSPICIOUS)
    if "std_ratio" in metrics.columns:
        cols["volatility_suspicious"] = F.col("std_ratio") > F.lit(STD_RATIO_SUSPICIOUS)
    return metrics.withColumns(cols)


def _pivot_splits(metrics: DataFrame, by: Sequence[str], cols: Sequence[str], split_col: str) -> DataFrame:
    aggs = []
    for c in cols:
        for s in ("train", "test"):
            aggs.append(F.max(F.when(F.col(split_col) == s, F.col(c))).alias(f"{s}_{c}"))
    return metrics.groupBy(*by).agg(*aggs)


def da_gap(metrics: DataFrame, by: Sequence[str], split_col: str = "split") -> DataFrame:
    """AU-04: ``train DA - test DA`` classified as test_better / overfitting / similar."""
    w = _pivot_splits(metrics, by, ["directional_accuracy"], split_col)
    gap = F.col("train_directional_accuracy") - F.col("test_directional_accuracy")
    return w.withColumn("da_gap", gap).withColumn(
        "da_gap_class",
        F.when(gap < F.lit(DA_GAP_TEST_BETTER), F.lit("test_better"))
        .when(gap > F.lit(DA_GAP_OVERFIT), F.lit("possible_overfitting"))
        .when(gap.isNotNull(), F.lit("similar")))


def overfitting(metrics: DataFrame, by: Sequence[str], split_col: str = "split") -> DataFrame:
    """AU-05: GOOD if R² gap < 0.05 and 0.9 < MAE ratio < 1.1, MILD if R² gap < 0.1,
    else SEVERE; UNKNOWN when a split's metrics are missing."""
    w = _pivot_splits(metrics, by, ["rmse", "mae", "r2"], split_col)
    r2_gap = F.col("train_r2") - F.col("test_r2")
    mae_ratio = F.when(F.col("train_mae") > 0, F.col("test_mae") / F.col("train_mae"))
    rmse_ratio = F.when(F.col("train_rmse") > 0, F.col("test_rmse") / F.col("train_rmse"))
    missing = F.col("train_rmse").isNull() | F.col("test_rmse").isNull()
    good = (r2_gap < F.lit(R2_GAP_GOOD)) & mae_ratio.isNotNull() & (mae_ratio > F.lit(MAE_RATIO_LOW)) & (
        mae_ratio < F.lit(MAE_RATIO_HIGH))
    diagnosis = (F.when(missing, F.lit("UNKNOWN")).when(good, F.lit("GOOD"))
                 .when(r2_gap < F.lit(R2_GAP_MILD), F.lit("MILD")).otherwise(F.lit("SEVERE")))
    return w.withColumns({"r2_gap": r2_gap, "mae_ratio": mae_ratio, "rmse_ratio": rmse_ratio,
                          "diagnosis": diagnosis, "r2_gap_warning": r2_gap > F.lit(R2_GAP_MILD)})


def consistency(metrics: DataFrame, by: Sequence[str], focus_model: str, model: str = "model") -> DataFrame:
    """AU-06: models with DA > 0.52 and R² > 0, and the recommendation tier of the
    focus model (DA > 0.70 suspicious, > 0.60 good, else realistic)."""
    good = (F.col("directional_accuracy") > F.lit(GOOD_MODEL_DA)) & (F.col("r2") > 0)
    focus_da = F.max(F.when(F.col(model) == focus_model, F.col("directional_accuracy")))
    out = metrics.groupBy(*by).agg(F.count(F.lit(1)).alias("models"), F.count_if(good).alias("good_models"),
                                   focus_da.alias("focus_da"))
    return out.withColumns({
        "only_focus_good": (F.col("good_models") == 1) & (F.col("focus_da") > F.lit(DA_SUSPICIOUS)),
        "multiple_good": F.col("good_models") >= 2,
        "tier": F.when(F.col("focus_da") > F.lit(TIER_SUSPICIOUS_DA), F.lit("suspicious"))
        .when(F.col("focus_da") > F.lit(TIER_GOOD_DA), F.lit("good")).otherwise(F.lit("realistic")),
    })


def return_recomputation(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ret: str = "ret", target: str = "target",
                         eps: float = 1e-9) -> DataFrame:
    """AU-07: per series, rows whose stored return differs from ``close/prev - 1``
    and rows whose target differs from the next stored return (beyond ``eps``)."""
    return count_mismatches(with_recomputed(df, spec, ret), spec, ret, target, eps)


def with_recomputed(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ret: str = "ret") -> DataFrame:
    """The return that the prices give and the next stored one."""
    w = spec.window()
    return df.withColumns({"__rc": F.try_divide(F.col("close"), F.lag("close", 1).over(w)) - 1, "__nx": F.lead(ret, 1).over(w)})


def count_mismatches(d: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ret: str = "ret", target: str = "target", eps: float = 1e-9) -> DataFrame:
    return d.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col(ret) - F.col("__rc")) > eps).alias("return_mismatches"),
        F.count_if(F.abs(F.col(target) - F.col("__nx")) > eps).alias("target_mismatches"),
    )


def scaled_range(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AU-08: min/max of every scaled feature and whether it stays in [0, 1]."""
    wide = df.groupBy(*by).agg(*[F.struct(F.lit(f).alias("feature"), F.min(f).alias("min"),
                                          F.max(f).alias("max")).alias(f) for f in features])
    long = wide.select(*by, F.explode(F.array(*[F.col(f) for f in features])).alias("s")).select(*by, "s.*")
    return long.withColumn("in_unit_range", (F.col("min") >= 0) & (F.col("max") <= 1))


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """AU-09: required columns absent from the frame's schema (one row each)."""
    return required_columns(df, required).filter(~F.col("present")).select("column", "present")


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """AU-09: each required column: whether the frame has it, and the rows that have a value in it; a column that is there but
    empty is as useless as an absent one (``usable`` is false for both)."""
    have = set(df.columns)
    aggs = [F.struct(F.lit(c).alias("column"), F.lit(c in have).alias("present"), (F.count(c) if c in have else F.lit(0).cast("bigint")).alias("non_null")).alias(f"r{i}")
            for i, c in enumerate(required)]
    if not aggs:
        return df.sparkSession.createDataFrame([], "column string, present boolean, non_null bigint, usable boolean")
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggs).select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(aggs))]))).withColumn("usable", F.col("non_null") > 0)


def history_gate(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, backtest_rows: int = BACKTEST_MIN_ROWS,
                 training_rows: int = TRAINING_MIN_ROWS) -> DataFrame:
    """AU-10: per series row count and whether it supports a backtest / training."""
    out = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("rows"))
    return out.withColumns({"backtest_ok": F.col("rows") >= F.lit(backtest_rows),
                            "training_ok": F.col("rows") >= F.lit(training_rows)})


def file_profile(df: DataFrame, file_col: str = "_file", keys: Sequence[str] = ("symbol", "ts"), date_col: str = "ts",
                 precedence: Sequence[str] | None = None) -> DataFrame:
    """AU-11: per source file rows, first/last date, and the rows that survive a keep-last
    merge by ``keys`` (``precedence`` columns ascending, by default the file name)."""
    last = F.max(F.struct(*(precedence or [file_col]), F.col(file_col).alias("__file")))
    unique = df.groupBy(*keys).agg(last["__file"].alias(file_col)).groupBy(file_col).agg(F.count(F.lit(1)).alias("unique_rows"))
    rows = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
    return rows.join(unique, file_col, "left").fillna(0, ["unique_rows"])
