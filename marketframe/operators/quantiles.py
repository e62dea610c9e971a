"""AG-08: exact quantiles of groups of any size by distributed rank selection.

The ranks that quantiles need are looked for by histograms: values are counted in bins between the smallest and the
largest (a partial aggregate, one row a bin), only the bins that hold a wanted rank stay, with their own smallest and
largest value, and the rest is counted again, until a bin holds one value or at most ``finish`` rows; those few are numbered. Rows that
are in no wanted bin go after the first round. A group is never in one buffer or one task: rows meet
their ranges by a salted key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.operators.layout import join_null_safe
from marketframe.session import checkpoint

SALTS = 64
INF = float("inf")


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (), bins: int = 1024,
                    finish: int = 10_000) -> DataFrame:
    """``(by..., column, quantiles)``: the quantiles in order of ``qs``, by linear interpolation, as ``percentile`` gives them: NULLs
    are left out, NaN is the largest value. Groups without values have no row."""
    keys = [*by, "column"]
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]))).where("v IS NOT NULL")
    v = F.col("v")
    finite = ~F.isnan(v) & (F.abs(v) < F.lit(INF))
    counts = checkpoint(long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v == F.lit(-INF)).alias("low"), F.count_if(finite).alias("mid"), F.count_if(v == F.lit(INF)).alias("high"),
        F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi")))
    place = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    wanted = F.array_distinct(F.array(*[f(place(q)).cast("bigint") for q in qs for f in (F.floor, F.ceil)]))
    ranks = counts.withColumn("rank", F.explode(wanted))
    outside = (F.when(F.col("rank") < F.col("low"), F.lit(-INF)).when(F.col("rank") >= F.col("low") + F.col("mid") + F.col("high"), F.lit(float("nan")))
               .when(F.col("rank") >= F.col("low") + F.col("mid"), F.lit(INF)).when(F.col("lo") == F.col("hi"), F.col("lo")))
    state = checkpoint(ranks.select(*keys, "rank", (F.col("rank") - F.col("low")).alias("left"), "lo", "hi", F.col("mid").alias("rows"), outside.alias("value")))
    done = state.where("value IS NOT NULL").select(*keys, "rank", "value")
    open_, values = state.where("value IS NULL").drop("value"), long.where(finite)
    while not open_.where(F.col("rows") > finish).isEmpty():
        hist = _in_ranges(values, open_, keys).groupBy(*keys, "lo", "hi", _bin(bins).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("c").over(Window.partitionBy(*keys, "lo", "hi").orderBy("bin")) - F.col("c")  # at most ``bins`` rows
        hist = hist.withColumn("before", before)
        here = (F.col("left") >= F.col("before")) & (F.col("left") < F.col("before") + F.col("c"))
        state = checkpoint(_with_keys(open_, hist, [*keys, "lo", "hi"]).where(here).select(
            *keys, "rank", (F.col("left") - F.col("before")).alias("left"), F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("c").alias("rows")))
        done = done.unionByName(state.where("lo = hi").select(*keys, "rank", F.col("lo").alias("value")))
        open_ = state.where("lo < hi")
        values = checkpoint(_in_ranges(values, open_, keys).select(*keys, "v"))
    few = _in_ranges(values, open_, keys).withColumn("left", F.row_number().over(Window.partitionBy(*keys, "lo", "hi").orderBy("v")).cast("bigint") - 1)
    done = done.unionByName(_with_keys(open_.drop("rows"), few, [*keys, "lo", "hi", "left"]).select(*keys, "rank", F.col("v").alias("value")))
    found = done.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))  # two ranks a quantile
    out = _with_keys(counts.select(*keys, "n"), found, keys)
    return out.select(*keys, F.array(*[_between(place(q)) for q in qs]).alias("quantiles"))


def _between(place: Column) -> Column:
    low, high = F.floor(place).cast("bigint"), F.ceil(place).cast("bigint")
    a, b = F.col("at")[low], F.col("at")[high]
    return F.when((low == high) | (a == b), a).otherwise((high - place) * a + (place - low) * b)


def _bin(bins: int) -> Column:
    """Bin of ``v`` between ``lo`` and ``hi``, not falling with v; the ends are in different bins. Where the ends are orders of magnitude
    apart, bins are equal in the logarithm, so that few rounds do for any distribution."""
    scale = lambda c: F.signum(c) * F.when(F.col(c) == 0, 0.0).otherwise(F.log2(F.abs(c)) + 1100.0)
    near = (F.signum("lo") == F.signum("hi")) & (F.least(F.abs("lo"), F.abs("hi")) * 16.0 >= F.greatest(F.abs("lo"), F.abs("hi")))
    at = {c: F.when(near, F.col(c)).otherwise(scale(c)) for c in ("v", "lo", "hi")}
    share = (at["v"] - at["lo"]) / (at["hi"] - at["lo"])
    return F.least(F.floor(share * F.lit(float(bins))), F.lit(bins - 1)).cast("int")


def _with_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_null_safe(left, right.select(*[c for c in right.columns if c in keys or c not in left.columns]), keys)


def _in_ranges(values: DataFrame, open_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, v, lo, hi) within a wanted range of their group."""
    ranges = open_.select(*keys, "lo", "hi").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = values.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return _with_keys(salted, ranges, [*keys, "salt"]).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).select(*keys, "v", "lo", "hi")
