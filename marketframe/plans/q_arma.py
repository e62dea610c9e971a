"""Registered queries: differencing order, autoregressive order search and walk-forward forecasts whose
closed forms SQL can state (no lags in the ADF test, one autoregressive term, no moving average)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketframe.operators import arma
from marketframe.plans import train
from marketframe.plans.q_bars import BAR_TRAIN_SQL
from marketframe.plans.registry import DAILY, W, register, rounded
from marketframe.sources import panels

BLOCK = {"block_rows": 200, "chunk": "day"}
REFIT = 20
# a series that remembers: yesterday's volatility tells today's
COL = "vol_20d"


def bt(spark, sf_dir):
    return train.bar_training_frame(spark, sf_dir)


# each series, its running sum and that one's running sum: integrated once and twice
SUMS_SQL = f"""{DAILY},
z AS (SELECT *, close - avg(close) OVER (PARTITION BY symbol) AS v FROM daily),
z1 AS (SELECT *, sum(v) OVER (PARTITION BY symbol ORDER BY ts) AS v1 FROM z),
z2 AS (SELECT *, sum(v1) OVER (PARTITION BY symbol ORDER BY ts) AS v2 FROM z1),
p AS (SELECT symbol || '+0' AS symbol, ts, v FROM z2 UNION ALL SELECT symbol || '+1', ts, v1 FROM z2 UNION ALL SELECT symbol || '+2', ts, v2 FROM z2)"""


def summed(spark, sf_dir):
    d = panels.daily(spark, sf_dir)
    mean, run = Window.partitionBy("symbol"), Window.partitionBy("symbol").orderBy("ts")
    d = d.withColumn("v0", F.col("close") - F.avg("close").over(mean)).withColumn("v1", F.sum("v0").over(run)).withColumn("v2", F.sum("v1").over(run))
    every = F.explode(F.array(*[F.struct(F.concat("symbol", F.lit(f"+{k}")).alias("symbol"), F.col(f"v{k}").alias("close")) for k in range(3)]))
    return d.select("ts", "seq", every.alias("s")).select("s.symbol", "ts", "seq", "s.close")


@register("ml08_difference_order_daily",
          f"""WITH {SUMS_SQL},
x AS (SELECT symbol, 0 AS d, ts, v FROM p UNION ALL SELECT symbol, 1, ts, v - lag(v) OVER (PARTITION BY symbol ORDER BY ts) FROM p),
s AS (SELECT symbol, d, v - lag(v) OVER (PARTITION BY symbol, d ORDER BY ts) AS dv, lag(v) OVER (PARTITION BY symbol, d ORDER BY ts) AS v1
      FROM x WHERE v IS NOT NULL),
g AS (SELECT symbol, d, count(*) AS n, regr_sxx(dv, v1) AS sxx, regr_sxy(dv, v1) AS sxy, regr_syy(dv, v1) AS syy FROM s WHERE dv IS NOT NULL GROUP BY symbol, d),
t AS (SELECT symbol, d, (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) < -2.86154 - 2.8903 / n - 4.234 / pow(n, 2) - 40.04 / pow(n, 3) AS stationary FROM g)
SELECT symbol, CAST(coalesce(min(CASE WHEN stationary THEN d END), 2) AS BIGINT) AS d FROM t GROUP BY symbol""", covers=("ML-08", "AG-17"))
def difference_order_daily(spark, sf_dir):
    return arma.difference_order(summed(spark, sf_dir), "close", maxlag=0, block_rows=500, chunk="month")


AR1_SQL = f"""{BAR_TRAIN_SQL},
l AS (SELECT *, lag(vol_20d) OVER ({W}) AS l1, row_number() OVER ({W}) AS pos FROM bt),
g AS (SELECT symbol, count(*) AS n, avg(vol_20d) AS mean, regr_sxx(vol_20d, l1) AS sxx, regr_sxy(vol_20d, l1) AS sxy, regr_syy(vol_20d, l1) AS syy,
             regr_slope(vol_20d, l1) AS slope, regr_intercept(vol_20d, l1) AS b0 FROM l WHERE split = 'train' AND l1 IS NOT NULL GROUP BY symbol),
c AS (SELECT symbol, 0 AS p, n, syy / n AS sigma2, mean AS intercept, CAST(0 AS DOUBLE) AS phi FROM g
      UNION ALL SELECT symbol, 1, n, (syy - sxy * sxy / sxx) / n, b0, slope FROM g),
a AS (SELECT *, n * ln(sigma2) + 2 * (p + 2) AS aic FROM c),
o AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY aic, p) = 1)"""


@register("ml08_ar1_order_bars",
          rounded(f"WITH {AR1_SQL}\nSELECT symbol, CAST(p AS BIGINT) AS p, n, sqrt(sigma2) AS sigma, aic, intercept, phi FROM a", ["sigma", "aic", "intercept", "phi"]),
          covers=("ML-08",))
def ar1_order_bars(spark, sf_dir):
    c = arma.select_order(bt(spark, sf_dir), COL, 1, 0, 1, **BLOCK)["candidates"]
    return c.select("symbol", "p", "n", F.sqrt("sigma2").alias("sigma"), "aic", "intercept", F.col("coef")[0].alias("phi"))


@register("ml09_walk_forward_ar1_bars",
          rounded(f"""WITH {AR1_SQL}
SELECT l.symbol, ts, seq, vol_20d AS actual, CASE WHEN p = 0 THEN intercept ELSE intercept + phi * l1 END AS pred, CAST(p AS BIGINT) AS p
FROM l JOIN o ON l.symbol = o.symbol WHERE split = 'test'""", ["actual", "pred"]), covers=("ML-09",))
def walk_forward_ar1_bars(spark, sf_dir):
    return arma.walk_forward(bt(spark, sf_dir), COL, 1, 0, 1, **BLOCK).select("symbol", "ts", "seq", "actual", "pred", "p")


@register("ml09_refit_ar1_bars",
          rounded(f"""WITH {AR1_SQL},
t AS (SELECT l.*, p, CAST((pos - min(pos) OVER (PARTITION BY l.symbol)) // {REFIT} AS BIGINT) AS rb, min(pos) OVER (PARTITION BY l.symbol) AS cut
      FROM l JOIN o ON l.symbol = o.symbol WHERE split = 'test'),
b AS (SELECT DISTINCT symbol, rb, cut + rb * {REFIT} AS start FROM t),
f AS (SELECT b.symbol, b.rb, avg(vol_20d) AS mean, regr_slope(vol_20d, l1) AS slope, regr_intercept(vol_20d, l1) AS b0
      FROM b JOIN l ON l.symbol = b.symbol AND l.pos < b.start AND l.l1 IS NOT NULL GROUP BY b.symbol, b.rb)
SELECT t.symbol, ts, seq, vol_20d AS actual, CASE WHEN p = 0 THEN mean ELSE b0 + slope * l1 END AS pred, CAST(p AS BIGINT) AS p
FROM t JOIN f ON t.symbol = f.symbol AND t.rb = f.rb""", ["actual", "pred"]), covers=("ML-09",))
def refit_ar1_bars(spark, sf_dir):
    return arma.walk_forward(bt(spark, sf_dir), COL, 1, 0, 1, refit_rows=REFIT, **BLOCK).select("symbol", "ts", "seq", "actual", "pred", "p")


@register("ml09_walk_forward_level_daily", covers=("ML-09", "ML-08"))
def walk_forward_level_daily(spark, sf_dir):
    """Forecasts of prices: differenced as the test says, integrated back."""
    from marketframe.operators import rows

    d = rows.split_fraction(summed(spark, sf_dir))
    return arma.walk_forward(d, "close", 2, 1, 8, max_d=2, refit_rows=100, block_rows=1000, chunk="month")
