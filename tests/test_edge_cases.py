"""FIXTURES.md §C edge cases on tiny literal panels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.functions.columns import corr_safe
from marketframe.operators import clean, evaluate as ev, features as wn, linear, rows, scale
from marketframe.operators import runs as rg
from marketframe.spec import DEFAULT_SPEC

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, ts timestamp_ntz, seq long, open double, high double, low double, close double"


def series(spark, closes, symbol="A", ohlc=None):
    out = []
    for i, c in enumerate(closes):
        o, h, lo = ohlc[i] if ohlc else (c, c, c)
        out.append((symbol, T0 + dt.timedelta(days=i), i, o, h, lo, c))
    return spark.createDataFrame(out, SCHEMA)


def col(df, name, order="seq"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]


@pytest.mark.parametrize("n,serving,training", [(49, 0, 0), (50, 1, 0), (51, 2, 1)])
def test_c1_ma50_gate(spark, n, serving, training):
    df = wn.feature_superset(series(spark, [1.0 + 0.01 * i for i in range(n)]))
    feats = wn.superset_names()
    assert df.na.drop(subset=feats).count() == serving
    assert wn.training_rows(df, feats).count() == training


def test_c2_rsi_and_flat_series(spark):
    rising = wn.rsi(series(spark, [float(i + 1) for i in range(20)]))
    vals = col(rising, "rsi_14")
    assert vals[:13] == [None] * 13 and all(v == 100.0 for v in vals[13:])
    flat = wn.volatility(wn.returns(wn.rsi(series(spark, [5.0] * 25))), (5,))
    assert all(v is None for v in col(flat, "rsi_14"))
    assert [v for v in col(flat, "vol_5d") if v is not None] == [0.0] * 20
    s = scale.transform_minmax(flat.withColumn("split", F.lit("train")), ["close"])
    assert set(col(s, "close")) == {0.0}


def test_c3_zero_and_negative_close_filtered(spark):
    df = clean.positive_prices(series(spark, [1.0, 0.0, -2.0, 2.0]))
    assert col(wn.returns(df), "ret") == [None, 1.0]


def test_c4_null_close_blocks_rolling(spark):
    df = series(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0])
    ma = col(wn.moving_averages(df, (3,)), "ma_3")
    assert ma == [None, None, None, None, None, 5.0, 6.0]


def test_c6_zero_prediction(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.1, 0.0)], "actual double, pred double")
    r = df.agg(M.directional_accuracy("actual", "pred").alias("da"),
               F.sum(M.position("pred")).alias("pos")).first()
    assert r.da == 0.5 and r.pos == -2.0


def test_c7_sharpe_zero_cases(spark):
    one = spark.createDataFrame([(0.1, 0.2)], "actual double, pred double")
    const = spark.createDataFrame([(0.1, 0.2)] * 5, "actual double, pred double")
    assert one.agg(M.sharpe("actual", "pred")).first()[0] == 0.0
    assert const.agg(M.sharpe("actual", "pred")).first()[0] == 0.0


def test_c8_r2_constant_actuals(spark):
    perfect = spark.createDataFrame([(1.0, 1.0)] * 3, "actual double, pred double")
    off = spark.createDataFrame([(1.0, 2.0)] * 3, "actual double, pred double")
    assert perfect.agg(M.r2("actual", "pred")).first()[0] == 1.0
    assert off.agg(M.r2("actual", "pred")).first()[0] == 0.0


def test_c9_fold_remainder_in_first_block(spark):
    df = linear.fold_blocks(series(spark, [1.0 + i for i in range(20)]))
    counts = {r.block: r.c for r in df.groupBy("block").agg(F.count("*").alias("c")).collect()}
    # t = 20 // 6 = 3, first block = 20 - 5*3 = 5 rows
    assert counts == {0: 5, 1: 3, 2: 3, 3: 3, 4: 3, 5: 3}


def test_c10_date_split_fallback_per_series(spark):
    a = series(spark, [1.0] * 10, "A")
    b = series(spark, [1.0] * 30, "B")
    s = rows.split_at_date(a.unionByName(b), T0 + dt.timedelta(days=20))
    got = {(r.symbol, r.split): r.c for r in s.groupBy("symbol", "split").agg(F.count("*").alias("c")).collect()}
    assert got == {("A", "train"): 8, ("A", "test"): 2, ("B", "train"): 20, ("B", "test"): 10}


def test_c11_equal_rmse_most_recent_wins(spark):
    runs = spark.createDataFrame([
        ("r1", T0, {"model_type": "lin"}, {}, {"rmse": 1.0}, "active"),
        ("r2", T0 + dt.timedelta(days=1), {"model_type": "lin"}, {}, {"rmse": 1.0}, "active"),
        ("r3", T0 + dt.timedelta(days=2), {"model_type": "lin"}, {}, {}, "active"),
    ], "run_id string, start_time timestamp_ntz, params map<string,string>, tags map<string,string>, "
       "metrics map<string,double>, lifecycle_stage string")
    assert rg.best_per_type(runs).first().run_id == "r2"
    assert rg.global_best(runs).first().run_id == "r2"


def test_c12_test_values_not_clipped(spark):
    df = spark.createDataFrame([("A", 0.0, "train"), ("A", 10.0, "train"), ("A", 20.0, "test")],
                               "symbol string, x double, split string")
    assert sorted(r.x for r in scale.transform_minmax(df, ["x"]).collect()) == [0.0, 1.0, 2.0]


def test_c13_column_order_by_name(spark, tmp_path):
    from marketframe.sources import files
    (tmp_path / "a.csv").write_text("Date,Close,Open\n2024-01-02,1.5,9.0\n")
    (tmp_path / "b.csv").write_text("Date,Open,Close\n2024-01-03,8.0,1.6\n")
    r = {x.Date.isoformat(): (x.Close, x.Open) for x in files.read_ragged(spark, str(tmp_path)).collect()}
    assert r == {"2024-01-02": (1.5, 9.0), "2024-01-03": (1.6, 8.0)}


def test_c14_first_row_nulls_and_rsi_counts_it(spark):
    df = series(spark, [1.0, 2.0, 3.0], ohlc=[(1.0, 1.5, 0.5), (2.0, 2.5, 1.5), (3.0, 3.5, 2.5)])
    tr = wn.true_range(wn.returns(df))
    assert col(tr, "ret")[0] is None and col(tr, "true_range")[0] is None
    r = col(wn.rsi(df, n=2), "rsi_2")
    assert r == [None, 100.0, 100.0]


def test_c15_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(corr_safe("a", "b")).first()[0] is None


def test_confusion_keeps_label_order(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0), ("m", -1.0, 1.0), ("m", 0.0, 1.0)],
                               "model string, actual double, pred double")
    got = {(r.actual_dir, r.pred_dir): r.n for r in ev.direction_confusion(df, ["model"]).collect()}
    assert got == {(1, 1): 1, (1, -1): 0, (-1, 1): 1, (-1, -1): 0}


def test_default_spec_orders_by_ts_then_seq():
    assert DEFAULT_SPEC.order == ("ts", "seq")


def test_au09_missing_columns(spark):
    from marketframe.operators import audit
    df = series(spark, [1.0, 2.0])
    assert [r.column for r in audit.missing_columns(df, ["close", "ret", "open"]).collect()] == ["ret"]


def test_fs07_feature_metadata(spark):
    from marketframe.operators import selection
    df = spark.createDataFrame([("A", 1.0, 2.0, 0.1, 3.0)], "symbol string, ret double, ma_5 double, target double, "
                                                            "close_unscaled double")
    meta = {r.column: (r.role, r.scaled, r.selected) for r in
            selection.feature_metadata(df, ["ret"], ["ret", "ma_5"]).collect()}
    assert meta == {"symbol": ("key", False, False), "ret": ("feature", True, True),
                    "ma_5": ("key", True, False), "target": ("label", False, False),
                    "close_unscaled": ("unscaled", False, False)}


def test_pointer_json_roundtrip(spark):
    from marketframe.operators import runs as rg
    from marketframe.sources import files
    v = spark.createDataFrame([("r1", "lin", 0.5, 0.7, 0.51)],
                              "run_id string, model_type string, rmse double, baseline_rmse double, baseline_da double")
    text = rg.pointer_json(v).select("pointer")
    back = files.parse_json_column(text, "pointer", files.POINTER_SCHEMA).select("parsed.*").first()
    assert back.model_name == "model_lin" and back.metrics.rmse == 0.5
    assert back.baseline_metrics.directional_accuracy == 0.51


def test_clean_column_name():
    from marketframe.sources.files import clean_column_name
    assert clean_column_name("('Close', 'EURUSD=X')") == "Close"
    assert clean_column_name(" Open ") == "Open"


def test_dedupe_idempotent(spark):
    from marketframe.operators.rows import dedupe_keep_last
    df = spark.createDataFrame([("A", 1, 1.0, 0), ("A", 1, 2.0, 1), ("A", 2, 3.0, 0)],
                               "symbol string, ts int, close double, _prec int")
    once = dedupe_keep_last(df, ("symbol", "ts"), ("_prec",))
    twice = dedupe_keep_last(once, ("symbol", "ts"), ("_prec",))
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.ts: r.close for r in once.collect()} == {1: 2.0, 2: 3.0}


def test_no_lookahead(spark):
    base = [1.0 + 0.1 * i for i in range(60)]
    changed = base[:40] + [9.0] * 20
    a = wn.extended_features(series(spark, base, ohlc=[(c, c, c) for c in base]), with_target=False)
    b = wn.extended_features(series(spark, changed, ohlc=[(c, c, c) for c in changed]), with_target=False)
    cols = ["ret", "ma_20", "rsi_14", "atr_14", "vol_20d", "lag_5"]
    ra = a.filter("seq < 40").orderBy("seq").select(*cols).collect()
    rb = b.filter("seq < 40").orderBy("seq").select(*cols).collect()
    assert ra == rb
