"""Halo blocks: fixed-lookback windows for a series too large for one task
(SURVEY §4, physical rule 3).

A plain ``Window.partitionBy(symbol)`` puts a whole series into one task; with one
series holding a third of 100 TB that task never finishes. Here a series is cut
into blocks of ``block_rows`` consecutive rows keyed by ``(symbol, block)``, and the
``lookback`` rows before each block (plus ``lookahead`` rows after it) are copied in
as *halo* rows. Any feature whose frame reaches at most ``lookback`` rows back and
``lookahead`` rows forward is then exact inside every block; the halo rows are
dropped afterwards.

Row positions are computed without a whole-series window: rows are counted per
``(symbol, time chunk)`` (a partial aggregate), a running sum over that small chunk
table gives each chunk's offset, and a window per ``(symbol, chunk)`` ranks rows
inside the chunk. Every step is partitioned by something finer than the series.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.session import checkpoint
from marketframe.spec import DEFAULT_SPEC, SeriesSpec

# the deepest look-back of the feature superset: a 50-row moving average
DEFAULT_LOOKBACK = 50
CHUNK = 65_536


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join by key in which a NULL key is a key like any other, as in windows."""
    renamed = right.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]).drop(*[f"__key_{k}" for k in keys])


def positions(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, chunk: str = "hour") -> DataFrame:
    """0-based row position ``__pos`` and series length ``__n`` per series, computed
    through ``(key, time chunk)`` partitions instead of one window per series."""
    keys = list(spec.keys)
    # a time that is a number is cut by its value
    numeric = isinstance(df.schema[spec.time].dataType, T.NumericType)
    d = df.withColumn("__chunk", F.floor(F.col(spec.time) / F.lit(CHUNK)) if numeric else F.date_trunc(chunk, F.col(spec.time)))
    counts = d.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*keys).orderBy("__chunk")
    offs = counts.withColumns({
        "__off": F.coalesce(F.sum("__cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__n": F.sum("__cnt").over(Window.partitionBy(*keys)),
    }).drop("__cnt")
    # one row per (key, chunk): AQE broadcasts it when small, else a shuffle join
    d = join_null_safe(d, offs, [*keys, "__chunk"])
    local = Window.partitionBy(*keys, "__chunk").orderBy(*spec.order)
    return d.withColumn("__pos", F.col("__off") + F.row_number().over(local) - 1).drop("__off")


def halo_blocks(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, lookback: int = DEFAULT_LOOKBACK,
                lookahead: int = 1, block_rows: int = 1_000_000, chunk: str = "hour") -> tuple[DataFrame, SeriesSpec]:
    """Blocked layout plus the spec to compute features on it.

    Returns ``(frame, blocked_spec)``; ``frame`` has ``__block``, ``__pos``, ``__n``
    and ``__halo``. Pass ``blocked_spec`` to the feature operators, then
    :func:`drop_halo`."""
    if block_rows <= max(lookback, lookahead):
        raise ValueError("block_rows must exceed the halo width")
    d = positions(df, spec, chunk)
    b = F.floor(F.col("__pos") / F.lit(block_rows)).cast("bigint")
    r = F.col("__pos") % F.lit(block_rows)

    def place(block, halo: bool):
        return F.struct(block.alias("__block"), F.lit(halo).alias("__halo"))

    # positions are computed once; a row goes to its own block and, near an edge, to the neighbour's halo
    places = F.array(place(b, False), F.when(r >= F.lit(block_rows - lookback), place(b + 1, True)),
                     F.when((r < F.lit(lookahead)) & (b > 0), place(b - 1, True)))
    out = d.withColumn("__p", F.explode(F.filter(places, lambda p: p.isNotNull())))
    out = out.withColumns({"__block": F.col("__p")["__block"], "__halo": F.col("__p")["__halo"]}).drop("__p")
    blocked = replace(spec, keys=tuple(spec.keys) + ("__block",), order=("__pos",))
    return out, blocked


# how many earlier rows a feature reads, by its name; rolling returns read one more than their window
REACH = ((r"(?:.*_)?ma_(\d+)$", -1), (r"(?:.*_)?(?:rsi|atr)_(\d+)$", 0), (r"(?:.*_)?(?:ret|vol)_(\d+)d$", 0), (r"(?:.*_)?lag_(\d+)$", 1))
REACH_FIXED = {"ret": 1, "true_range": 1, "vol_ratio": 20, "diff": 1}


def lookback_for(features: Sequence[str]) -> int:
    """Rows of look-back that the named features need; unknown names read their own row only."""
    need = [0]
    for f in features:
        name = f.removesuffix("_prev")
        own = max([int(m[1]) + extra for rx, extra in REACH if (m := re.match(rx, name))], default=REACH_FIXED.get(name, 0))
        need.append(own + (name != f))
    return max(need)


def on_blocks(df: DataFrame, build: Callable[[DataFrame, SeriesSpec], DataFrame], spec: SeriesSpec = DEFAULT_SPEC,
              lookback: int = 0, lookahead: int = 0, block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """Any windowed operator on the blocked layout: ``build(frame, blocked_spec)`` sees the
    blocks with their halos (and ``__pos``, ``__n``); its rows come back without them. Exact
    for operators that reach at most ``lookback`` rows back and ``lookahead`` forward."""
    frame, blocked = halo_blocks(df, spec, lookback, lookahead, block_rows, chunk)
    return drop_halo(build(frame, blocked)).drop("__pos", "__n")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("__halo")).drop("__halo", "__block", "__chunk")


def split_fraction_blocked(df: DataFrame, fraction: float = 0.8, out: str = "split") -> DataFrame:
    """SL-06 on the blocked layout: the global position and length are columns, so
    the split needs no window at all."""
    cut = F.floor(F.col("__n") * F.lit(float(fraction)))
    return df.withColumn(out, F.when(F.col("__pos") < cut, F.lit("train")).otherwise(F.lit("test")))


def fold_blocks_blocked(df: DataFrame, n_splits: int = 5, out: str = "block") -> DataFrame:
    """ML-03 on positions: the fold of a row is arithmetic, without a window."""
    t = F.floor(F.col("__n") / F.lit(n_splits + 1))
    first = F.col("__n") - F.lit(n_splits) * t
    fold = F.when(F.col("__pos") < first, F.lit(0)).otherwise(F.lit(1) + F.floor((F.col("__pos") - first) / t))
    return df.withColumn(out, F.when(t > 0, fold).cast("int"))


def rows_between_blocked(df: DataFrame, first: int, last: int, pos_col: str = "pos") -> DataFrame:
    """SL-09 on positions: 1-based rows ``first..last`` of every series."""
    return df.withColumn(pos_col, F.col("__pos") + 1).where(F.col(pos_col).between(first, last))


def equity_curve_blocked(df: DataFrame, ret_col: str, spec: SeriesSpec = DEFAULT_SPEC, out: str = "equity",
                         block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """WN-13 for a series too large for one task: growth within each block, times the
    running product of the blocks before it (one row per block)."""
    frame, blocked = halo_blocks(df, spec, 0, 0, block_rows, chunk)
    growth = F.coalesce(F.lit(1.0) + F.col(ret_col), F.lit(1.0))
    ends = frame.groupBy(*blocked.keys).agg(F.product(growth).alias("__g"), F.count(ret_col).alias("__c"))
    before = Window.partitionBy(*spec.keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumns({"__carry": F.coalesce(F.product("__g").over(before), F.lit(1.0)), "__seen": F.coalesce(F.sum("__c").over(before), F.lit(0))}).drop("__g", "__c")
    w = blocked.cumulative()
    d = frame.join(carry, list(blocked.keys))
    value = F.when(F.col("__seen") + F.count(ret_col).over(w) > 0, F.col("__carry") * F.product(growth).over(w))
    return drop_halo(d.withColumn(out, value)).drop("__pos", "__n", "__carry", "__seen")


def autocorrelation_blocked(df: DataFrame, col: str, nlags: int, spec: SeriesSpec = DEFAULT_SPEC,
                            block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """AG-05 for a series too large for one task: the mean is one partial aggregate, the lagged
    products come from blocks with ``nlags`` rows of halo. Long form ``(keys..., lag, acf)``."""
    d = df.where(F.col(col).isNotNull())
    mean = d.groupBy(*spec.keys).agg(F.avg(col).alias("__mean"))
    frame, blocked = halo_blocks(d, spec, nlags, 0, block_rows, chunk)
    x = frame.join(mean, list(spec.keys)).withColumn("__d", F.col(col) - F.col("__mean"))
    w = blocked.window()
    x = drop_halo(x.withColumns({f"__l{k}": F.lag("__d", k).over(w) for k in range(1, nlags + 1)}))
    den = F.sum(F.col("__d") * F.col("__d"))
    wide = x.groupBy(*spec.keys).agg(*[F.try_divide(F.coalesce(F.sum(F.col("__d") * F.col(f"__l{k}")), F.lit(0.0)), den).alias(str(k)) for k in range(1, nlags + 1)])
    return wide.unpivot(list(spec.keys), [str(k) for k in range(1, nlags + 1)], "lag", "acf").withColumn("lag", F.col("lag").cast("bigint"))


# ------------------------------------------------------------------ heavy hitters
HOT_ROWS = 5_000_000
MAX_HOT = 10_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT) -> DataFrame:
    """Keys of the series of over ``hot_rows`` rows, the longest ``max_hot`` of them: small enough to
    broadcast, whatever the data. Counting reads the key columns only."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_rows)
    return checkpoint(counts.orderBy(F.desc("__rows"), *keys).limit(max_hot).select(*keys))


def routed(frames: Sequence[DataFrame], plain: Callable[..., DataFrame], blocked: Callable[..., DataFrame], keys: Sequence[str] = ("symbol",),
           hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT) -> DataFrame:
    """An operator on series of very different lengths: rows of series of over ``hot_rows`` rows (in the first frame) go through
    ``blocked``, all others through ``plain``, and the results are one. Both take all frames and give the same columns. The counts are made
    first; where no series is that long the plan is the plain one."""
    hot = hot_keys(frames[0], keys, hot_rows, max_hot)
    if hot.isEmpty():
        return plain(*frames)
    listed = F.broadcast(hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys]
    long, short = ([f.join(listed, same, how) for f in frames] for how in ("left_semi", "left_anti"))
    out = plain(*short)
    return out.unionByName(blocked(*long).select(out.columns))


def split_fraction_routed(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, fraction: float = 0.8, out: str = "split", hot_rows: int = HOT_ROWS,
                          chunk: str = "hour") -> DataFrame:
    """SL-06 for series of any length."""
    from marketframe.operators import rows

    def blocked(d: DataFrame) -> DataFrame:
        return split_fraction_blocked(positions(d, spec, chunk), fraction, out).drop("__pos", "__n", "__chunk")

    return routed([df], lambda d: rows.split_fraction(d, spec, fraction, out), blocked, spec.keys, hot_rows)


def split_at_date_routed(df: DataFrame, test_start, spec: SeriesSpec = DEFAULT_SPEC, fraction: float = 0.8, out: str = "split",
                         hot_rows: int = HOT_ROWS, chunk: str = "hour") -> DataFrame:
    """SL-07 for series of any length: positions from the chunks' counts, the last time from an aggregate."""
    from marketframe.operators import rows

    def blocked(d: DataFrame) -> DataFrame:
        last = d.groupBy(*spec.keys).agg(F.max(spec.time).alias("__max"))
        start = rows.date_column(test_start)
        p = join_null_safe(split_fraction_blocked(positions(d, spec, chunk), fraction, "__by_fraction"), F.broadcast(last), spec.keys)  # MAX_HOT rows
        by_date = F.when(F.col(spec.time) < start, F.lit("train")).otherwise(F.lit("test"))
        return p.withColumn(out, F.when(F.col("__max") < start, F.col("__by_fraction")).otherwise(by_date)).drop("__pos", "__n", "__chunk", "__max", "__by_fraction")

    return routed([df], lambda d: rows.split_at_date(d, test_start, spec, fraction, out), blocked, spec.keys, hot_rows)


def transform_minmax_routed(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("symbol",), split_col: str = "split",
                            fit_on: str = "train", hot_rows: int = HOT_ROWS) -> DataFrame:
    """FS-02, fit and transform, for series of any length: a long one is scaled by its stored parameters, from a partial aggregate."""
    from marketframe.operators import scale

    def blocked(d: DataFrame) -> DataFrame:
        return scale.transform_minmax(d, features, scale.fit_minmax(d, features, keys, split_col, fit_on), keys, split_col, fit_on)

    return routed([df], lambda d: scale.transform_minmax(d, features, None, keys, split_col, fit_on), blocked, keys, hot_rows)


def tail_align_routed(actual: DataFrame, pred: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, actual_col: str = "actual", pred_col: str = "pred",
                      pad: float = 0.0, hot_rows: int = HOT_ROWS, chunk: str = "hour") -> DataFrame:
    """JN-05 for series of any length: both sides are numbered from the end by their positions and meet by number."""
    from marketframe.operators import joins

    def numbered(d: DataFrame, cols: Sequence[str]) -> DataFrame:
        return positions(d.select(*spec.keys, *spec.order, *cols), spec, chunk).withColumn("rn_desc", (F.col("__n") - F.col("__pos")).cast("int"))

    def blocked(a: DataFrame, p: DataFrame) -> DataFrame:
        a = numbered(a, [actual_col]).select(*spec.keys, *spec.order, actual_col, "rn_desc")
        p = numbered(p, [pred_col]).select(*spec.keys, "rn_desc", F.col(pred_col).alias("__p"))
        return a.join(p, [*spec.keys, "rn_desc"], "left").withColumn(pred_col, F.coalesce("__p", F.lit(pad))).drop("__p")

    return routed([actual, pred], lambda a, p: joins.tail_align(a, p, spec, actual_col, pred_col, pad), blocked, spec.keys, hot_rows)


def return_recomputation_routed(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, ret: str = "ret", target: str = "target", eps: float = 1e-9,
                                hot_rows: int = HOT_ROWS, block_rows: int = 1_000_000, chunk: str = "hour") -> DataFrame:
    """AU-07 for series of any length: a block reads one row on either side."""
    from marketframe.operators import audit

    def blocked(d: DataFrame) -> DataFrame:
        return audit.count_mismatches(on_blocks(d, lambda x, s: audit.with_recomputed(x, s, ret), spec, 1, 1, block_rows, chunk), spec, ret, target, eps)

    return routed([df], lambda d: audit.return_recomputation(d, spec, ret, target, eps), blocked, spec.keys, hot_rows)
