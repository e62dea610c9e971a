"""Registered queries: whole-series operators on the blocked layout, for a series too large for
one task. Each has the SQL of its plain twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.operators import features as wn, layout
from marketframe.plans import train
from marketframe.plans.q_bars import SEQ_FEATURES, SEQ_STEPS
from marketframe.plans.q_stats import ACF_LAGS
from marketframe.plans.registry import ORACLE, register

BLOCK = {"block_rows": 100, "chunk": "day"}


def bt(spark, sf_dir):
    return train.bar_training_frame(spark, sf_dir)


@register("wn13_equity_curve_halo_bars", ORACLE["wn13_equity_curve_bars"], covers=("WN-13",))
def equity_curve_halo_bars(spark, sf_dir):
    t = bt(spark, sf_dir).filter(F.col("split") == "test").withColumn("strat", M.strategy_return("target", "ret"))
    t = layout.equity_curve_blocked(t, "strat", **BLOCK)
    t = layout.equity_curve_blocked(t, "target", out="buy_hold_equity", **BLOCK)
    return t.select("symbol", "ts", "seq", "equity", "buy_hold_equity")


@register("wn14_forward_returns_halo_bars", ORACLE["wn14_forward_returns_bars"], covers=("WN-14",))
def forward_returns_halo_bars(spark, sf_dir):
    t = layout.on_blocks(bt(spark, sf_dir), lambda d, spec: wn.forward_returns(d, (1, 5, 10), spec), lookahead=10, **BLOCK)
    return t.select("symbol", "ts", "seq", "split", "fwd_ret_1", "fwd_ret_5", "fwd_ret_10")


@register("wn15_sequences_halo_bars", ORACLE["wn15_sequences_bars"], covers=("WN-15",))
def sequences_halo_bars(spark, sf_dir):
    t = layout.on_blocks(bt(spark, sf_dir), lambda d, spec: wn.sequences(d, SEQ_FEATURES, SEQ_STEPS, spec), lookback=SEQ_STEPS - 1, **BLOCK)
    fmt = F.transform("window", lambda a: F.array_join(F.transform(a, lambda x: F.format_string("%.6f", F.round(x, 6) + F.lit(0.0))), ","))
    return t.select("symbol", "ts", "seq", "split", "target", F.array_join(fmt, ";").alias("window_text"))


@register("ag05_autocorrelation_halo_bars", ORACLE["ag05_autocorrelation_bars"], covers=("AG-05",))
def autocorrelation_halo_bars(spark, sf_dir):
    a = layout.autocorrelation_blocked(bt(spark, sf_dir).filter(F.col("split") == "train"), "ret", ACF_LAGS, **BLOCK)
    return a.withColumn("significant", F.abs("acf") > F.lit(0.05))


@register("ml03_fold_blocks_halo_bars", ORACLE["ml03_fold_blocks_bars"], covers=("ML-03",))
def fold_blocks_halo_bars(spark, sf_dir):
    """Folds by position: no window over the series."""
    f = layout.fold_blocks_blocked(layout.positions(bt(spark, sf_dir).filter(F.col("split") == "train"), chunk="day"))
    return f.groupBy("symbol", "block").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("sl09_rows_between_halo_ticks", ORACLE["sl09_rows_between_ticks"], covers=("SL-09",))
def rows_between_halo_ticks(spark, sf_dir):
    from marketframe.sources import panels
    r = layout.rows_between_blocked(layout.positions(panels.ticks(spark, sf_dir), chunk="day"), 5, 8)
    return r.select("symbol", "ts", "seq", "close", "pos")


# ------------------------------------------------------------------ heavy hitters: some series each way
@register("sl06_split_routed_ticks", ORACLE["sl06_split_ticks"], covers=("SL-06",))
def split_routed_ticks(spark, sf_dir):
    from marketframe.operators import clean
    from marketframe.sources import panels
    f = train.tick_features(clean.positive_prices(panels.ticks(spark, sf_dir, positive_only=False)))
    t = layout.split_fraction_routed(wn.training_rows(f, train.TICK_FEATURES), hot_rows=55, chunk="day")
    return t.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("sl07_date_split_routed_ticks", ORACLE["sl07_date_split_ticks"], covers=("SL-07",))
def date_split_routed_ticks(spark, sf_dir):
    from marketframe.plans.q_prep import DATE_SPLIT_TICKS
    from marketframe.sources import panels
    s = layout.split_at_date_routed(panels.ticks(spark, sf_dir), DATE_SPLIT_TICKS, hot_rows=70, chunk="day")
    return s.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("fs02_minmax_scale_routed_bars", ORACLE["fs02_minmax_scale_bars"], covers=("FS-02",))
def minmax_scale_routed_bars(spark, sf_dir):
    from marketframe.plans import q_prep
    return q_prep.scaled_bars(spark, sf_dir, lambda t, cols: layout.transform_minmax_routed(t, cols, hot_rows=120))


@register("jn05_tail_align_routed_bars", ORACLE["jn05_tail_align_bars"], covers=("JN-05",))
def tail_align_routed_bars(spark, sf_dir):
    from marketframe.plans import q_prep
    return q_prep.tail_aligned(spark, sf_dir, lambda a, p: layout.tail_align_routed(a, p, hot_rows=0, chunk="day"))


@register("au07_return_recomputation_routed_bars", ORACLE["au07_return_recomputation_bars"], covers=("AU-07",))
def return_recomputation_routed_bars(spark, sf_dir):
    return layout.return_recomputation_routed(bt(spark, sf_dir), hot_rows=120, **BLOCK)


@register("ag08_describe_selected_bars", ORACLE["ag08_describe_bars"], covers=("AG-08",))
def describe_selected_bars(spark, sf_dir):
    """Quartiles by rank selection: no group is in one buffer."""
    from marketframe.operators import stats
    from marketframe.plans.q_stats import _DESC
    return stats.describe(bt(spark, sf_dir), _DESC, ["symbol"], select=True)
