"""Scheduled retrain as one Spark job.

Every series is an experiment. Each configured model is fitted per series on the
training split, scored on the test split and logged as a run; runs are ranked into
champion/challenger/candidate aliases; the top-N aliased models are refitted with
their *stored* feature configuration on all rows, registered as the next version
and the aliases are repointed (no performance gate, as in the reference); a summary
compares old and new test RMSE. Unlike the reference chain, features are recomputed
in the same DAG, so a retrain never reads stale processed data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.functions import metrics as M
from marketframe.operators import arma, linear
from marketframe.operators import runs as rg
from marketframe.session import checkpoint
from marketframe.spec import SeriesSpec

G = ["experiment"]


@dataclass(frozen=True)
class Arma:
    """An autoregressive config: order (p, q) with the smallest AIC on the training split, at most these, on the
    last values of ``col`` and the residuals of an AR(m)."""

    max_p: int = 2
    max_q: int = 1
    m: int = 8
    col: str = "ret"


Config = tuple[Sequence[str], float] | Arma
STAGES = ("initial", "retrain")


def design_columns(configs: Mapping[str, Config]) -> list[str]:
    """The union of all configs' regressors."""
    out: dict[str, None] = {}
    for c in configs.values():
        names = _arma_names(c) if isinstance(c, Arma) else c[0]
        out |= dict.fromkeys(names)
    return list(out)


def _arma_names(c: Arma) -> list[str]:
    # the target is the next value, so the current one is its first lag
    return [c.col, *(f"y_l{i}" for i in range(1, c.max_p))][: c.max_p] + ["e", *(f"e_l{j}" for j in range(1, c.max_q))][: c.max_q]


def add_design(frame: DataFrame, configs: Mapping[str, Config], split_col: str, spec: SeriesSpec) -> DataFrame:
    """``frame`` with the lags and residuals that the autoregressive configs read: one design, as wide as the widest."""
    some = [c for c in configs.values() if isinstance(c, Arma)]
    if not some:
        return frame
    if len({(c.col, c.m) for c in some}) > 1:
        raise ValueError("autoregressive configs of one retrain share their series and m")
    p, q = max(c.max_p for c in some), max(c.max_q for c in some)
    d = arma.arma_design(frame, some[0].col, max(p - 1, 0), max(q, 1), some[0].m, spec, F.col(split_col) == "train")
    return d.drop("__pos", "__n", "__block")


def fit_all(frame: DataFrame, configs: Mapping[str, Config], by: Sequence[str], split_col: str = "split", target: str = "target") -> DataFrame:
    """ML-18: every config of every series, fitted on the training split (stage ``initial``) and on all rows (``retrain``), from
    one Gram of the union of the design columns per (series, split): ``(by..., stage, model_type, n, intercept, coef)``, coef over the union. An
    autoregressive config keeps the order that it chose on the training split. Fits use the rows where the whole design is there."""
    by, names = list(by), design_columns(configs)
    k = len(names)
    grams = linear.gram(frame, names, target, [*by, split_col])
    schema = T.StructType([*[grams.schema[c] for c in by], T.StructField("stage", T.StringType()), T.StructField("model_type", T.StringType()), *linear.COEF_FIELDS])
    plans = {name: c if isinstance(c, Arma) else ([names.index(f) for f in c[0]], float(c[1])) for name, c in configs.items()}

    def solve(gram: tuple, columns: list[int], alpha: float) -> tuple[float, np.ndarray, float]:
        n, mean, c = gram
        sel = [*columns, k]
        b0, beta = linear._solve(n, mean[sel], c[np.ix_(sel, sel)], alpha) if columns else (float(mean[k]), np.zeros(0))
        full = np.zeros(k)
        full[columns] = beta
        return b0, full, linear._sse(n, mean[sel], c[np.ix_(sel, sel)], b0, beta)

    def order(gram: tuple, config: Arma) -> list[int]:
        own = [names.index(f) for f in _arma_names(config)]
        best = None
        for p in range(config.max_p + 1):
            for q in range(config.max_q + 1):
                columns = own[:p] + own[config.max_p : config.max_p + q]
                sse = solve(gram, columns, 0.0)[2]
                aic = gram[0] * math.log(max(sse, 1e-300) / gram[0]) + 2 * (p + q + 2)
                if best is None or aic < best[0]:
                    best = aic, columns
        return best[1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = dict(zip(pdf[split_col], linear._row_parts(pdf, k + 1), strict=True))
        out, key = [], [pdf[c].iloc[0] for c in by]
        if "train" in parts:
            stages = {"initial": parts["train"], "retrain": linear._merge([parts[s] for s in sorted(parts, reverse=True)])}
            for name, plan in plans.items():
                columns, alpha = (order(parts["train"], plan), 0.0) if isinstance(plan, Arma) else plan
                for stage, gram in stages.items():
                    b0, full, _ = solve(gram, columns, alpha)
                    out.append([*key, stage, name, gram[0], b0, full.tolist()])
        return pd.DataFrame(out, columns=schema.names)

    return grams.groupBy(*by).applyInPandas(run, schema)


def score_all(rows: DataFrame, coefs: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Every fit of :func:`fit_all` on the rows of its series: one join, whatever the number of configs."""
    fits = coefs.groupBy(key).agg(F.collect_list(F.struct("stage", "model_type", "intercept", "coef")).alias("fits"))  # two a config
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in names])
    whole = F.lit(True)
    for f in names:
        whole = whole & F.col(f).isNotNull()
    d = rows.where(whole).select(key, "ts", F.col("target").alias("actual"), x.alias("__x")).join(fits, key)
    d = d.select(key, "ts", "actual", "__x", F.inline("fits"))
    dot = F.aggregate(F.zip_with("coef", "__x", lambda c, v: c * v), F.lit(0.0), lambda a, b: a + b)
    return d.select(key, "ts", "actual", (F.col("intercept") + dot).alias("pred"), "model_type", "stage")


def _runs(preds: DataFrame, run_prefix: Column, key: str = "symbol", stage: Sequence[str] = ()) -> DataFrame:
    a, p = F.col("actual"), F.col("pred")
    m = preds.filter(a.isNotNull() & p.isNotNull()).groupBy(key, "model_type", *stage).agg(
        M.rmse(a, p).alias("rmse"), M.mae(a, p).alias("mae"),
        M.directional_accuracy(a, p).alias("directional_accuracy"), F.max("ts").alias("start_time"))
    return m.select(
        F.col(key).cast("string").alias("experiment"),
        F.concat(run_prefix, F.col("model_type"), F.lit("_"), F.col(key).cast("string")).alias("run_id"),
        "start_time", F.create_map(F.lit("model_type"), F.col("model_type")).alias("params"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("mae"), F.col("mae"),
                     F.lit("directional_accuracy"), F.col("directional_accuracy")).alias("metrics"),
        F.lit("active").alias("lifecycle_stage"), *stage)


def retrain(frame: DataFrame, configs: Mapping[str, Config], top_n: int = 3, split_col: str = "split", key: str = "symbol") -> dict[str, DataFrame]:
    """Returns ``runs``, ``aliases`` (before), ``picked`` (RG-06), ``new_versions``
    (RG-12), ``aliases_after`` and ``summary`` (RG-13).

    Whatever the number of configs: one pass over the frame for the Gram rows, one for the scores."""
    spec = SeriesSpec(keys=(key,))
    frame = checkpoint(add_design(frame, configs, split_col, spec))
    names = design_columns(configs)
    preds = score_all(frame.filter(F.col(split_col) == "test"), fit_all(frame, configs, [key], split_col), names, key)
    # one small row per series, config and stage, used many times below
    both = checkpoint(_runs(preds, F.concat("stage", F.lit("_")), key, ["stage"]))
    runs = both.where("stage = 'initial'").drop("stage")
    ranked = rg.rank_finalists(rg.best_per_type(runs, G), G, type_recency=rg.type_recency(runs, G))
    name = F.concat(F.col("experiment"), F.lit("_"), F.col("model_type"))
    versions = ranked.select("experiment", name.alias("name"), "run_id", F.lit(1).cast("bigint").alias("version"))
    aliases = ranked.select("experiment", name.alias("name"), "alias", F.lit(1).cast("bigint").alias("version"))
    picked = checkpoint(rg.top_by_alias(aliases, versions, G, top_n))
    new_runs = both.where("stage = 'retrain'").drop("stage")
    # ML-18: the picked models, refitted with their stored configuration on all rows
    new_named = new_runs.select("experiment", F.concat(F.col("experiment"), F.lit("_"), rg.model_type_col()).alias("name"), "run_id")
    new_versions = rg.register_next(versions, picked.select("experiment", "name", "alias"), new_named, G)
    aliases_after = rg.repoint_aliases(aliases, new_versions, G)
    old = versions.join(runs.select("experiment", "run_id", rg.metric("rmse").alias("rmse")), ["experiment", "run_id"])
    new = new_versions.join(new_runs.select("experiment", "run_id", rg.metric("rmse").alias("rmse")), ["experiment", "run_id"])
    summary = rg.retrain_summary(old.join(picked.select("experiment", "name"), ["experiment", "name"]), new, G)
    return {"runs": runs, "aliases": aliases, "picked": picked, "new_versions": new_versions,
            "aliases_after": aliases_after, "summary": summary}
