"""Correlation-based feature selection.

Inputs are the long correlation tables of :mod:`marketframe.operators.stats`
(``target_correlation`` and ``correlation_matrix``), which have at most k and
k(k-1)/2 rows per group. The relational prune (FS-05) is plain joins on those
small tables, or expressions on one Gram row per group, which holds both; the
order-dependent greedy prune (FS-06) runs per group in pandas over at most k² rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference for equal results.
MUST_KEEP = ["ret", "ma_50", "ret_20d", "lag_2", "lag_3", "open", "high", "low", "close"]
TARGET_CORR_MIN = 0.03
REDUNDANT_CORR = 0.95


def _order_table(spark, features: Sequence[str], must_keep: Sequence[str]) -> DataFrame:
    rows = [(f, i, f in set(must_keep)) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, ord int, must_keep boolean")


def candidates(target_corr: DataFrame, features: Sequence[str], by: Sequence[str] = (),
               must_keep: Sequence[str] = MUST_KEEP, threshold: float = TARGET_CORR_MIN) -> DataFrame:
    """FS-04: must-keep features (that exist) plus features with |corr| > threshold.
    Output ``(by..., feature, ord, must_keep, abs_corr)``."""
    order = _order_table(target_corr.sparkSession, features, must_keep)
    t = target_corr.select(*by, "feature", F.abs("corr").alias("abs_corr"))
    j = t.join(F.broadcast(order), "feature")  # order table: one row per feature name
    return j.filter(F.col("must_keep") | (F.col("abs_corr") > F.lit(threshold))).select(
        *by, "feature", "ord", "must_keep", "abs_corr")


def redundancy_prune(cands: DataFrame, corr_matrix: DataFrame, by: Sequence[str] = (),
                     threshold: float = REDUNDANT_CORR) -> DataFrame:
    """FS-05: for candidate pairs with |corr| > threshold (not both must-keep), drop the
    one less correlated with the target (ties and NULL scores drop the later one),
    unless that one is must-keep. Returns the kept candidates with a ``dropped`` flag
    table applied: ``(by..., feature, ord, must_keep, abs_corr)``."""
    a = cands.select(*by, F.col("feature").alias("feature_a"), F.col("ord").alias("ord_a"),
                     F.col("must_keep").alias("mk_a"), F.col("abs_corr").alias("s_a"))
    b = cands.select(*by, F.col("feature").alias("feature_b"), F.col("ord").alias("ord_b"),
                     F.col("must_keep").alias("mk_b"), F.col("abs_corr").alias("s_b"))
    m = corr_matrix.select(*by, "feature_a", "feature_b", F.abs("corr").alias("pc"))
    # the matrix holds each unordered pair once; orient it by candidate order
    m2 = m.unionByName(m.select(*by, F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"),
                                "pc"))
    p = m2.join(a, [*by, "feature_a"]).join(b, [*by, "feature_b"]).filter(F.col("ord_a") < F.col("ord_b"))
    p = p.filter(~(F.col("mk_a") & F.col("mk_b")) & (F.col("pc") > F.lit(threshold)))
    loser = F.when(F.col("s_a") < F.col("s_b"), F.col("feature_a")).otherwise(F.col("feature_b"))
    loser_mk = F.when(F.col("s_a") < F.col("s_b"), F.col("mk_a")).otherwise(F.col("mk_b"))
    dropped = p.filter(~loser_mk).select(*by, loser.alias("feature")).distinct()
    return cands.join(dropped, [*by, "feature"], "left_anti")


def pruned(gram: DataFrame, features: Sequence[str], by: Sequence[str] = (), must_keep: Sequence[str] = MUST_KEEP,
           threshold: float = TARGET_CORR_MIN, redundant: float = REDUNDANT_CORR) -> DataFrame:
    """FS-04 and FS-05 from one Gram row per group (``linear.gram`` of ``features`` and the target, complete rows): the candidates
    that :func:`redundancy_prune` would keep, as ``(by..., feature, ord, must_keep, abs_corr)``. Both tables of
    correlations stand in the Gram, so the rule is expressions on its row: no join, no further pass or shuffle."""
    feats = list(features)
    m = len(feats) + 1
    start = [i * m - i * (i - 1) // 2 for i in range(m)]  # of row i in the upper triangle

    def corr(i, j, ij) -> Column:
        den = F.sqrt(F.get("cm", i) * F.get("cm", j))
        return F.abs(F.when(den > 0, F.get("cm", ij) / den))

    last = F.lit(start[m - 1])
    one = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("ord"), F.lit(f in set(must_keep)).alias("must_keep"),
                             F.lit(start[i]).alias("ii"), F.lit(start[i] + m - 1 - i).alias("it")) for i, f in enumerate(feats)])
    scored = F.transform(one, lambda f: F.struct(f["feature"].alias("feature"), f["ord"].alias("ord"), f["must_keep"].alias("must_keep"),
                                                 corr(f["ii"], last, f["it"]).alias("abs_corr")))
    two = [(i, j) for i in range(m - 1) for j in range(i + 1, m - 1)]
    pairs = F.array(*[F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), F.lit(start[i]).alias("ii"), F.lit(start[j]).alias("jj"),
                               F.lit(start[i] + j - i).alias("ij")) for i, j in two]) if two else \
        F.array().cast("array<struct<a:int,b:int,ii:int,jj:int,ij:int>>")

    def side(x) -> Column:
        return F.get("scored", x)

    def taking_part(x) -> Column:
        return side(x)["must_keep"] | F.coalesce(side(x)["abs_corr"] > F.lit(threshold), F.lit(False))

    def loser(p) -> Column:
        return F.when(side(p["a"])["abs_corr"] < side(p["b"])["abs_corr"], p["a"]).otherwise(p["b"])

    def drops(p) -> Column:
        return taking_part(p["a"]) & taking_part(p["b"]) & (corr(p["ii"], p["jj"], p["ij"]) > F.lit(redundant)) & ~side(loser(p))["must_keep"]

    rows = gram.withColumn("scored", scored)
    rows = rows.withColumn("dropped", F.transform(F.filter(pairs, drops), loser))
    kept = F.filter("scored", lambda f: (f["must_keep"] | (f["abs_corr"] > F.lit(threshold))) & ~F.array_contains("dropped", f["ord"]))
    return rows.select(*by, F.inline(kept))


def surviving(corr: np.ndarray, score: np.ndarray, threshold: float) -> np.ndarray:
    """FS-06's rule on one group: which features stay.

    Features come up in order. A newcomer meets the earlier features that are still in
    and correlate with it by more than ``threshold``. It is out if any of them has the
    higher score; those of them that have not are out (so ties, and comparisons with a
    missing score, go to the newcomer). A newcomer that is out still meets all of them."""
    alive = np.zeros(len(score), bool)
    for new in range(len(score)):
        rivals = alive & (corr[new] > threshold)
        better = rivals & (score > score[new])
        alive ^= rivals & ~better
        alive[new] = not better.any()
    return alive


def greedy_prune(corr_matrix: DataFrame, target_corr: DataFrame, features: Sequence[str], by: Sequence[str] = (),
                 threshold: float = REDUNDANT_CORR) -> DataFrame:
    """FS-06: order-dependent prune of correlated features per group (see :func:`surviving`).
    Returns ``(by..., feature, dropped)`` for every feature. A group is k scores and at
    most k² correlations, gathered to two arrays before the Python step."""
    feats, keys = list(features), list(by) or ["__all"]
    if not by:
        corr_matrix, target_corr = (d.withColumn("__all", F.lit(0)) for d in (corr_matrix, target_corr))
    place = F.create_map(*[x for i, f in enumerate(feats) for x in (F.lit(f), F.lit(i))])
    scores = target_corr.groupBy(*keys).agg(F.collect_list(F.struct(place[F.col("feature")].alias("i"), F.abs("corr").alias("s"))).alias("scores"))
    pairs = corr_matrix.groupBy(*keys).agg(F.collect_list(F.struct(
        place[F.col("feature_a")].alias("i"), place[F.col("feature_b")].alias("j"), F.abs("corr").alias("c"))).alias("pairs"))
    k = len(feats)

    def run(it):
        for pdf in it:
            stays = []
            for r in pdf.itertuples(index=False):
                corr, score = np.full((k, k), np.nan), np.full(k, np.nan)
                for p in r.pairs if r.pairs is not None else ():
                    if p["i"] is not None and p["j"] is not None and p["c"] is not None:
                        corr[p["i"], p["j"]] = corr[p["j"], p["i"]] = p["c"]
                for p in r.scores:
                    if p["i"] is not None and p["s"] is not None:
                        score[p["i"]] = p["s"]
                stays.append(surviving(corr, score, threshold).tolist())
            yield pdf[keys].assign(stays=stays)

    joined = scores.join(pairs, keys, "left")
    fields = T.StructType([joined.schema[c] for c in keys] + [T.StructField("stays", T.ArrayType(T.BooleanType()))])
    out = joined.mapInPandas(run, fields)
    rows = F.arrays_zip(F.array(*[F.lit(f) for f in feats]).alias("feature"), F.transform("stays", lambda x: ~x).alias("dropped"))
    return out.select(*by, F.inline(rows))


def feature_metadata(df: DataFrame, selected: Sequence[str], scaled: Sequence[str],
                     unscaled: Sequence[str] = ("target", "ret_unscaled", "close_unscaled")) -> DataFrame:
    """FS-07: one row per column of the processed frame: its role after selection."""
    rows = []
    for i, c in enumerate(df.columns):
        role = ("feature" if c in selected else "label" if c == "target" else
                "unscaled" if c in unscaled else "key")
        rows.append((c, i, role, c in scaled, c in selected))
    return df.sparkSession.createDataFrame(rows, "column string, ord int, role string, scaled boolean, selected boolean")
