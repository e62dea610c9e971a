"""Halo blocks give exactly the features of the whole-series window."""

import math

from pyspark.sql import functions as F

from marketframe.operators import clean, features as wn, layout
from marketframe.sources import panels
from tests.conftest import SMALL

COLS = ["ret", "ma_5", "ma_10", "ma_20", "ma_50", "ret_5d", "ret_20d", "lag_1", "lag_2", "lag_3", "lag_5", "target",
        "rsi_14", "atr_14", "vol_5d", "vol_20d"]


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_halo_features_equal_plain_windows(spark):
    bars = clean.positive_prices(panels.bars_1h(spark, SMALL))
    plain = wn.extended_features(bars).select("symbol", "ts", *COLS)
    blocked, spec = layout.halo_blocks(bars, lookback=50, lookahead=1, block_rows=60, chunk="day")
    halo = layout.drop_halo(wn.extended_features(blocked, spec)).select("symbol", "ts", *COLS)
    p = {(r.symbol, r.ts): r for r in plain.collect()}
    h = {(r.symbol, r.ts): r for r in halo.collect()}
    assert p.keys() == h.keys()
    for k in p:
        for c in COLS:
            assert _same(p[k][c], h[k][c]), (k, c, p[k][c], h[k][c])


def test_blocked_positions_and_split(spark):
    ticks = panels.ticks(spark, SMALL)
    blocked, _ = layout.halo_blocks(ticks, lookback=5, lookahead=0, block_rows=20, chunk="day")
    d = layout.drop_halo(layout.split_fraction_blocked(blocked))
    from marketframe.operators import rows
    ref = rows.split_fraction(ticks)
    got = {(r.symbol, r.seq): r.split for r in d.select("symbol", "seq", "split").collect()}
    want = {(r.symbol, r.seq): r.split for r in ref.select("symbol", "seq", "split").collect()}
    assert got == want
    pos = d.groupBy("symbol").agg(F.min("__pos").alias("lo"), F.max("__pos").alias("hi"), F.count("*").alias("n"))
    assert all(r.lo == 0 and r.hi == r.n - 1 for r in pos.collect())


def test_lookback_follows_the_features():
    assert layout.lookback_for(["open", "target"]) == 0
    assert layout.lookback_for(["ma_50", "ret"]) == 49
    assert layout.lookback_for(["ret_20d", "lag_5"]) == 20
    assert layout.lookback_for(["lag_5", "lag_2"]) == 6
    assert layout.lookback_for(["rsi_14", "true_range"]) == 14
    assert layout.lookback_for(["ma_20_prev"]) == 20
    assert layout.lookback_for(COLS) == 49


def test_one_key_with_a_third_of_the_rows_spreads_over_blocks(spark):
    """A hot series: no (symbol, block) group is larger than a block and its halo, and the
    results are those of plain windows."""
    rows = [("hot", i, i, 100.0 + (i * 37 % 101)) for i in range(2000)] + [(f"s{k}", i, i, 50.0 + (i * 13 % 29)) for k in range(40) for i in range(100)]
    d = spark.createDataFrame(rows, "symbol string, sec bigint, seq bigint, close double").withColumn(
        "ts", F.timestamp_seconds(F.col("sec") * 600)).drop("sec")
    plain = wn.moving_averages(wn.returns(d), (5, 10))
    blocked = layout.on_blocks(d, lambda x, spec: wn.moving_averages(wn.returns(x, spec), (5, 10), spec),
                               lookback=layout.lookback_for(["ret", "ma_10"]), block_rows=150, chunk="hour")
    key = lambda r: (r.symbol, r.seq)
    a = {key(r): (r.ret, r.ma_5, r.ma_10) for r in plain.collect()}
    b = {key(r): (r.ret, r.ma_5, r.ma_10) for r in blocked.collect()}
    assert a.keys() == b.keys() and all(_same(x, y) for k in a for x, y in zip(a[k], b[k]))
    frame, spec = layout.halo_blocks(d, lookback=9, lookahead=0, block_rows=150, chunk="hour")
    assert frame.groupBy(*spec.keys).count().agg(F.max("count")).first()[0] <= 159
    e = {key(r): r.equity for r in wn.equity_curve(plain, "ret").collect()}
    f = {key(r): r.equity for r in layout.equity_curve_blocked(plain, "ret", block_rows=150).collect()}
    assert all(_same(e[k], f[k]) for k in e)
