"""Experiment-log tables as DataFrames.

``runs``: ``(group..., run_id, start_time, params MAP<STRING,STRING>,
tags MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>, lifecycle_stage)``;
``versions``: ``(group..., name, version, run_id)``; ``aliases``:
``(group..., name, alias, version)``. ``group`` (e.g. an experiment id) lets one
job rank many experiments at once; every ranking is a window partitioned by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
ALIAS_ORDER = ["champion", "challenger", "candidate"]
DELETE_DA_THRESHOLD = 0.8


def model_type_col() -> Column:
    """Model type from params, falling back to tags."""
    return F.coalesce(F.try_element_at("params", F.lit("model_type")),
                      F.try_element_at("tags", F.lit("model_type")))


def metric(name: str) -> Column:
    """A metric by name; NULL when the run did not log it."""
    return F.try_element_at("metrics", F.lit(name))


def flat(runs: DataFrame, group: Sequence[str] = (), metric_names: Sequence[str] = ("rmse",)) -> DataFrame:
    return runs.select(*group, "run_id", "start_time", model_type_col().alias("model_type"),
                       *[metric(m).alias(m) for m in metric_names], "lifecycle_stage")


def best_per_type(runs: DataFrame, group: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """RG-01: lowest metric per model type; ties go to the most recent run; runs
    without a type or metric are ignored."""
    f = flat(runs, group, [by]).filter(F.col("model_type").isNotNull() & F.col(by).isNotNull())
    w = Window.partitionBy(*group, "model_type").orderBy(F.col(by), F.col("start_time").desc(), F.col("run_id"))
    return f.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def global_best(runs: DataFrame, group: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """RG-02: overall best run (ties -> most recent) as a ``min_by`` aggregate."""
    f = flat(runs, group, [by]).filter(F.col("model_type").isNotNull() & F.col(by).isNotNull())
    order = F.struct(F.col(by), -F.unix_micros(F.col("start_time").cast("timestamp")), F.col("run_id"))
    pick = F.min_by(F.struct("run_id", "model_type", by, "start_time"), order)
    return f.groupBy(*group).agg(pick.alias("b")).select(*group, "b.*")


def rank_finalists(best: DataFrame, group: Sequence[str] = (), by: str = "rmse",
                   type_recency: DataFrame | None = None) -> DataFrame:
    """RG-03: rank per-type winners by the metric; alias champion / challenger /
    candidate / ``rank_{n}``. Ties keep the order in which types were first seen in a
    most-recent-first scan (``type_recency``: latest start per type)."""
    d = best
    order = [F.col(by)]
    if type_recency is not None:
        d = d.join(type_recency, [*group, "model_type"], "left")
        order.append(F.col("type_latest").desc())
    order.append(F.col("model_type"))
    w = Window.partitionBy(*group).orderBy(*order)
    d = d.withColumn("rank", F.row_number().over(w).cast("bigint"))
    alias = F.element_at(F.array(*[F.lit(a) for a in ALIAS_ORDER]), F.col("rank").cast("int"))
    alias = F.when(F.col("rank") <= len(ALIAS_ORDER), alias).otherwise(F.concat(F.lit("rank_"), F.col("rank")))
    out = d.withColumn("alias", alias)
    return out.drop("type_latest") if type_recency is not None else out


def type_recency(runs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    f = flat(runs, group, []).filter(F.col("model_type").isNotNull())
    return f.groupBy(*group, "model_type").agg(F.max("start_time").alias("type_latest"))


def champion_verdict(ranked: DataFrame, baseline: DataFrame, group: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """RG-04: champion vs the naive baseline (``baseline``: one row per group with
    ``baseline_rmse`` and ``baseline_da``) and the fields of the pointer record."""
    champ = ranked.filter(F.col("rank") == 1)
    if group:
        j = champ.join(baseline, list(group), "left")
    else:  # both sides hold exactly one row
        j = champ.withColumn("__g", F.lit(0)).join(baseline.withColumn("__g", F.lit(0)), "__g").drop("__g")
    return j.withColumn("verdict", F.when(F.col(by) < F.col("baseline_rmse"), F.lit("beats_baseline"))
                        .otherwise(F.lit("worse_than_baseline")))


def pointer_json(verdict: DataFrame, name_prefix: str = "model_") -> DataFrame:
    """RG-04 pointer record as JSON text (nested ``metrics`` / ``baseline_metrics``);
    ``model_version`` comes from a column ``version`` if there is one."""
    version = F.col("version").cast("string") if "version" in verdict.columns else F.lit(None).cast("string")
    name = F.concat(F.lit(name_prefix), F.col("model_type"))
    rec = F.struct(
        F.col("run_id"), F.col("model_type"), name.alias("model_name"), version.alias("model_version"), F.lit("champion").alias("model_alias"),
        F.concat(F.lit("models:/"), name, F.lit("@champion")).alias("model_uri"),
        F.struct(F.col("rmse")).alias("metrics"),
        F.struct(F.col("baseline_rmse").alias("rmse"), F.col("baseline_da").alias("directional_accuracy")).alias(
            "baseline_metrics"))
    return verdict.withColumn("pointer", F.to_json(rec))


def best_vs_latest(runs: DataFrame, group: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """RG-05: per type the best run and the latest run side by side."""
    best = best_per_type(runs, group, by).select(*group, "model_type", F.col("run_id").alias("best_run_id"),
                                                 F.col(by).alias(f"best_{by}"))
    f = flat(runs, group, [by]).filter(F.col("model_type").isNotNull())
    w = Window.partitionBy(*group, "model_type").orderBy(F.col("start_time").desc(), F.col("run_id").desc())
    latest = f.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").select(
        *group, "model_type", F.col("run_id").alias("latest_run_id"), F.col(by).alias(f"latest_{by}"))
    out = best.join(latest, [*group, "model_type"], "full")
    return out.withColumn("latest_is_best", F.col("best_run_id") == F.col("latest_run_id"))


def top_by_alias(aliases: DataFrame, versions: DataFrame, group: Sequence[str] = (), n: int = 3) -> DataFrame:
    """RG-06: for each alias in champion/challenger/candidate order (first ``n``), the
    first model name (ascending) holding it, with its version's run."""
    names = [*ALIAS_ORDER, *[f"rank_{i}" for i in range(len(ALIAS_ORDER) + 1, n + 1)]][:n]
    order = aliases.sparkSession.createDataFrame([(a, i) for i, a in enumerate(names)], "alias string, alias_rank int")
    a = aliases.join(F.broadcast(order), "alias")  # order: n rows
    w = Window.partitionBy(*group, "alias").orderBy("name")
    first = a.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return first.join(versions, [*group, "name", "version"], "left").select(
        *group, "alias", F.col("alias_rank").cast("bigint"), "name", "version", "run_id")


def resolve_alias(aliases: DataFrame, versions: DataFrame, group: Sequence[str] = (),
                  pointer_alias: str | None = None) -> DataFrame:
    """RG-07: per model name the version behind the first alias that exists in the
    chain (pointer alias, champion, challenger, candidate), else the latest version."""
    chain = ([pointer_alias] if pointer_alias else []) + ALIAS_ORDER
    prio = aliases.sparkSession.createDataFrame([(a, i) for i, a in enumerate(chain)], "alias string, prio int")
    cand = aliases.join(F.broadcast(prio), "alias").select(*group, "name", "version", "prio", F.col("alias").alias("via"))
    latest = versions.groupBy(*group, "name").agg(F.max("version").alias("version")).select(
        *group, "name", "version", F.lit(len(chain)).alias("prio"), F.lit("latest").alias("via"))
    allc = cand.unionByName(latest)
    pick = F.min_by(F.struct("version", "via"), F.col("prio"))
    return allc.groupBy(*group, "name").agg(pick.alias("p")).select(*group, "name", "p.version", "p.via")


def versions_matching(versions: DataFrame, runs: DataFrame, predicate: Column | None = None,
                      group: Sequence[str] = ()) -> DataFrame:
    """RG-08: versions whose run satisfies ``predicate`` (default DA > 0.8); runs in
    the deleted lifecycle stage are skipped."""
    pred = predicate if predicate is not None else (metric("directional_accuracy") > F.lit(DELETE_DA_THRESHOLD))
    r = runs.filter(F.col("lifecycle_stage") != "deleted").filter(pred).select(
        *group, "run_id", metric("directional_accuracy").alias("directional_accuracy"))
    return versions.join(r, [*group, "run_id"], "inner")


def orphan_versions(versions: DataFrame, runs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """RG-09 / JN-07: versions whose run is missing or deleted."""
    active = runs.filter(F.col("lifecycle_stage") != "deleted").select(*group, "run_id")
    return versions.join(active, [*group, "run_id"], "left_anti")


def stale_sample_runs(runs: DataFrame, current: DataFrame, group: Sequence[str] = ("symbol",),
                      param: str = "train_size") -> DataFrame:
    """RG-10: runs whose logged training size differs from the current training count
    (``current``: ``(group..., n_train)``)."""
    r = runs.select(*group, "run_id", model_type_col().alias("model_type"),
                    F.try_element_at("params", F.lit(param)).cast("bigint").alias("logged_train_size"))
    j = r.join(current, list(group), "inner")
    return j.filter(F.col("logged_train_size") != F.col("n_train"))


def top_runs(runs: DataFrame, k: int, group: Sequence[str] = (), by: str = "rmse", recent: bool = False,
             metric_names: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """RG-11: top ``k`` runs per group by metric (or by recency); metrics a run did
    not log come back NULL."""
    f = flat(runs, group, list(dict.fromkeys([by, *metric_names])))
    order = [F.col("start_time").desc(), F.col("run_id")] if recent else [F.col(by).asc_nulls_last(), F.col("run_id")]
    w = Window.partitionBy(*group).orderBy(*order)
    return f.withColumn("pos", F.row_number().over(w).cast("bigint")).filter(F.col("pos") <= k)


def register_next(versions: DataFrame, picked: DataFrame, new_runs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """RG-12: a new version ``max(version) + 1`` per retrained model name.
    ``picked``: ``(group..., name, alias)``; ``new_runs``: ``(group..., name, run_id)``."""
    nxt = versions.groupBy(*group, "name").agg((F.max("version") + 1).alias("version"))
    return picked.join(nxt, [*group, "name"]).join(new_runs, [*group, "name"]).select(
        *group, "name", "version", "run_id", "alias")


def repoint_aliases(aliases: DataFrame, new_versions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """RG-12: alias table upsert - the new version takes over the alias it retrained."""
    from marketframe.operators.rows import dedupe_keep_last
    old = aliases.select(*group, "name", "alias", "version").withColumn("_prec", F.lit(0))
    new = new_versions.select(*group, "name", "alias", "version").withColumn("_prec", F.lit(1))
    return dedupe_keep_last(old.unionByName(new), [*group, "name", "alias"], ("_prec",)).drop("_prec")


def repoint_retrained(aliases: DataFrame, versions: DataFrame, group: Sequence[str] = (), n: int = 3) -> DataFrame:
    """RG-12 in one pass over each table: the first name (ascending) behind each of the first ``n`` aliases is retrained, and
    its alias moves to ``max(version) + 1`` of that name; all other rows stay. The same table as :func:`top_by_alias`,
    :func:`register_next` and :func:`repoint_aliases` in turn."""
    names = [*ALIAS_ORDER, *[f"rank_{i}" for i in range(len(ALIAS_ORDER) + 1, n + 1)]][:n]
    place = F.row_number().over(Window.partitionBy(*group, "alias").orderBy("name"))
    top = versions.groupBy(*group, "name").agg((F.max("version") + 1).alias("__next"))
    d = aliases.withColumn("__first", (place == 1) & F.col("alias").isin(names)).join(top, [*group, "name"], "left")
    version = F.when(F.col("__first"), F.coalesce("__next", "version")).otherwise(F.col("version"))
    return d.select(*group, "name", "alias", version.alias("version"))


def retrain_summary(old: DataFrame, new: DataFrame, group: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """RG-13: old vs new metric per retrained model (``(group..., name, version, rmse)``
    on both sides) and the change."""
    o = old.select(*group, "name", F.col("version").alias("old_version"), F.col(by).alias(f"old_{by}"))
    n = new.select(*group, "name", F.col("version").alias("new_version"), F.col(by).alias(f"new_{by}"))
    j = o.join(n, [*group, "name"], "inner")
    return j.withColumn(f"{by}_change", F.col(f"new_{by}") - F.col(f"old_{by}"))
