"""Series and groups too large for one task: the same rows whichever way, with a third of them in one key."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.operators import audit, joins, layout, rows, scale, stats
from marketframe.operators.quantiles import exact_quantiles
from tests.test_oracle import _rows


@pytest.fixture(scope="module")
def skewed(spark):
    r = random.Random(2)
    lengths = {"hot": 900, None: 150, **{f"s{i}": r.randint(1, 60) for i in range(55)}}
    data = [(k, t, t % 3, round(r.uniform(1, 9), 3), None if r.random() < 0.02 else round(r.gauss(0, 1), 3)) for k, n in lengths.items() for t in range(n)]
    df = spark.createDataFrame(data, "symbol string, ts bigint, seq bigint, close double, ret double").repartition(7)
    return df.withColumn("target", F.lit(0.5)).persist()


def same(a, b):
    assert _rows(a.toPandas()) == _rows(b.select(a.columns).toPandas())


HOT = [0, 100, 10**9]


@pytest.mark.parametrize("hot_rows", HOT)
def test_splits(skewed, hot_rows):
    same(rows.split_fraction(skewed), layout.split_fraction_routed(skewed, hot_rows=hot_rows))
    plain = skewed.withColumn("ts", F.timestamp_seconds(F.col("ts") * 86400))
    same(rows.split_at_date(plain, "1970-02-10"), layout.split_at_date_routed(plain, "1970-02-10", hot_rows=hot_rows, chunk="month"))


@pytest.mark.parametrize("hot_rows", HOT)
def test_scaling_alignment_and_recomputation(skewed, hot_rows):
    s = rows.split_fraction(skewed.where("symbol IS NOT NULL"))
    same(scale.transform_minmax(s, ["close", "ret"]), layout.transform_minmax_routed(s, ["close", "ret"], hot_rows=hot_rows))
    a, p = s.select("symbol", "ts", "seq", F.col("close").alias("actual")), s.where("ts % 4 > 0").select("symbol", "ts", "seq", F.col("ret").alias("pred"))
    same(joins.tail_align(a, p), layout.tail_align_routed(a, p, hot_rows=hot_rows))
    same(audit.return_recomputation(s), layout.return_recomputation_routed(s, hot_rows=hot_rows, block_rows=64))


def test_hot_plan_has_no_window_over_a_series(skewed):
    out = layout.split_fraction_routed(skewed, hot_rows=100)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__chunk" in plan and "LeftAnti" in plan
    assert "LeftAnti" not in layout.split_fraction_routed(skewed, hot_rows=10**9)._jdf.queryExecution().optimizedPlan().toString()


VALUES = {
    "ties": [1.0] * 400 + [2.0] * 300 + [3.0],
    "wide": [10.0 ** random.Random(1).uniform(-300, 300) * random.Random(i).choice([-1, 1]) for i in range(50)] + [random.Random(i).gauss(0, 1) for i in range(500)],
    "odd": [float("nan")] * 5 + [float("inf")] * 7 + [-float("inf")] * 3 + [0.0, -0.0, 5e-324, 1e308, -1e308] + [0.25] * 9,
    "one": [4.5], "two": [1.0, 2.0], "nan": [float("nan")] * 4,
    "hot": np.random.default_rng(4).lognormal(0, 3, 6000).round(4).tolist(),
    None: [None, 1.0, None, 7.0, 3.0], "empty": [None, None],
}
QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("bins,finish", [(1024, 10_000), (64, 5)])
def test_quantiles_equal_percentile(spark, bins, finish):
    df = spark.createDataFrame([(k, v) for k, vs in VALUES.items() for v in vs], "g string, x double").repartition(6)
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(q) for q in QS])).alias("q")).collect()}
    got = {r.g: r.quantiles for r in exact_quantiles(df, ["x"], QS, ["g"], bins, finish).collect()}
    assert set(got) == {k for k, v in want.items() if v is not None} == set(VALUES) - {"empty"}
    for k, q in got.items():
        assert [str(x) if x != x or abs(x) == float("inf") else pytest.approx(x, rel=1e-12, abs=0) for x in want[k]] == [str(x) if x != x or abs(x) == float("inf") else x for x in q], k


def test_quantiles_without_keys_and_of_nothing(spark):
    df = spark.range(1001).withColumn("x", F.col("id").cast("double"))
    assert exact_quantiles(df, ["x", "id"], [0.5, 0.25], bins=16, finish=3).orderBy("column").collect() == [("id", [500.0, 250.0]), ("x", [500.0, 250.0])]
    assert exact_quantiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_describe_by_selection(skewed):
    a = stats.describe(skewed, ["close", "ret"], ["symbol"])
    b = stats.describe(skewed, ["close", "ret"], ["symbol"], select=True)
    same(a, b)
    assert "percentile" not in b._jdf.queryExecution().optimizedPlan().toString()
