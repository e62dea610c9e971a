"""Registered queries: run-log ranking tables built from forecasts on the tick panel.

Test-data adapter: one run per (series, predictor in naive / zero / ma5), metrics on
the series' test split, grouped into experiments ``exp_{symbol % 10}``; versions
register every run under ``{experiment}_{model_type}`` and the aliases come from
the championship ranking (RG-03).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.functions import metrics as M
from marketframe.operators import forecast
from marketframe.operators import runs as rg
from marketframe.plans import train
from marketframe.plans.q_series import TICK_FEATURES_SQL
from marketframe.plans.registry import register, rounded
from marketframe.session import checkpoint
from marketframe.spec import DEFAULT_SPEC

G = ["experiment"]


def tick_runs(spark, sf_dir):
    t = train.tick_training_frame(spark, sf_dir)
    t = t.withColumn("ma5", F.avg("ret").over(DEFAULT_SPEC.last(5)))
    n_train = t.filter(F.col("split") == "train").groupBy("symbol").agg(F.count(F.lit(1)).alias("n_train"))
    test = t.filter(F.col("split") == "test").select("symbol", "ts", F.col("target").alias("actual"), "ret", "ma5")
    # one pass: the three predictors of a row come from one explode
    preds = test.select("symbol", "ts", "actual", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), p.alias("pred")) for m, p in (("naive", F.col("ret")), ("zero", F.lit(0.0)), ("ma5", F.col("ma5")))])))
    a, p = F.col("actual"), F.col("pred")
    m = preds.groupBy("symbol", "model").agg(
        F.count(F.lit(1)).alias("n"), M.rmse(a, p).alias("rmse"), M.mae(a, p).alias("mae"),
        M.directional_accuracy(a, p).alias("directional_accuracy"), F.max("ts").alias("start_time"))
    m = m.join(n_train, "symbol")
    sym = F.col("symbol").cast("string")
    logged = F.when(F.col("model") == "ma5", F.col("n_train") - 5).otherwise(F.col("n_train")).cast("string")
    params = F.when(F.col("model") == "zero", F.create_map(F.lit("symbol"), sym, F.lit("train_size"), logged)) \
        .otherwise(F.create_map(F.lit("model_type"), F.col("model"), F.lit("symbol"), sym, F.lit("train_size"), logged))
    tags = F.when(F.col("model") == "zero", F.create_map(F.lit("model_type"), F.lit("zero"))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    metrics = F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("mae"), F.col("mae"),
                           F.lit("directional_accuracy"), F.col("directional_accuracy"))
    return m.select(
        F.concat(F.lit("exp_"), (F.col("symbol") % 10).cast("string")).alias("experiment"),
        F.col("symbol"),
        F.concat(F.col("model"), F.lit("_"), sym).alias("run_id"),
        "start_time", params.alias("params"), tags.alias("tags"), metrics.alias("metrics"),
        F.when(F.col("n") < 13, F.lit("deleted")).otherwise(F.lit("active")).alias("lifecycle_stage"),
        "n_train")


def active(runs):
    return runs.filter(F.col("lifecycle_stage") == "active")


def tick_versions(runs):
    from pyspark.sql import Window
    name = F.concat(F.col("experiment"), F.lit("_"), rg.model_type_col())
    v = runs.select("experiment", name.alias("name"), "run_id", "start_time")
    w = Window.partitionBy("experiment", "name").orderBy("start_time", "run_id")
    return v.withColumn("version", F.row_number().over(w).cast("bigint")).drop("start_time")


def tick_ranking(runs):
    act = active(runs)
    best = rg.best_per_type(act, G)
    return rg.rank_finalists(best, G, type_recency=rg.type_recency(act, G))


def tick_aliases(runs, versions):
    r = tick_ranking(runs).select("experiment", F.concat(F.col("experiment"), F.lit("_"), F.col("model_type")).alias(
        "name"), "run_id", "alias")
    return r.join(versions, ["experiment", "name", "run_id"]).select("experiment", "name", "alias", "version")


# ----------------------------------------------------------------- SQL twin
RUNS_SQL = f"""{TICK_FEATURES_SQL},
p AS (SELECT symbol, ts, seq, split, target AS actual, ret,
             avg(ret) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma5 FROM tt),
ntr AS (SELECT symbol, count(*) AS n_train FROM tt WHERE split = 'train' GROUP BY symbol),
preds AS (SELECT symbol, ts, actual, 'naive' AS model, ret AS pred FROM p WHERE split = 'test'
          UNION ALL SELECT symbol, ts, actual, 'zero', 0.0 FROM p WHERE split = 'test'
          UNION ALL SELECT symbol, ts, actual, 'ma5', ma5 FROM p WHERE split = 'test'),
m AS (SELECT symbol, model, count(*) AS n, sqrt(avg(pow(actual - pred, 2))) AS rmse, avg(abs(actual - pred)) AS mae,
             avg(CASE WHEN sign(actual) = sign(pred) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
             max(ts) AS start_time FROM preds GROUP BY symbol, model),
runs AS (SELECT 'exp_' || CAST(m.symbol % 10 AS VARCHAR) AS experiment, m.symbol,
                model || '_' || CAST(m.symbol AS VARCHAR) AS run_id, model AS model_type, start_time, rmse, mae,
                directional_accuracy, CASE WHEN n < 13 THEN 'deleted' ELSE 'active' END AS lifecycle_stage,
                CASE WHEN model = 'ma5' THEN n_train - 5 ELSE n_train END AS logged_train_size, n_train
         FROM m JOIN ntr ON m.symbol = ntr.symbol),
act AS (SELECT * FROM runs WHERE lifecycle_stage = 'active'),
best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY experiment, model_type
                                                ORDER BY rmse, start_time DESC, run_id) AS rn FROM act) WHERE rn = 1),
rec AS (SELECT experiment, model_type, max(start_time) AS type_latest FROM act GROUP BY experiment, model_type),
ranked AS (SELECT b.*, CAST(row_number() OVER (PARTITION BY b.experiment ORDER BY b.rmse, r.type_latest DESC,
                                                b.model_type) AS BIGINT) AS rank
           FROM best b JOIN rec r ON b.experiment = r.experiment AND b.model_type = r.model_type),
ranked2 AS (SELECT *, CASE rank WHEN 1 THEN 'champion' WHEN 2 THEN 'challenger' WHEN 3 THEN 'candidate'
                       ELSE 'rank_' || CAST(rank AS VARCHAR) END AS alias FROM ranked),
versions AS (SELECT experiment, experiment || '_' || model_type AS name, run_id,
                    CAST(row_number() OVER (PARTITION BY experiment, experiment || '_' || model_type
                                            ORDER BY start_time, run_id) AS BIGINT) AS version FROM runs),
aliases AS (SELECT v.experiment, v.name, r.alias, v.version FROM ranked2 r JOIN versions v
            ON v.experiment = r.experiment AND v.name = r.experiment || '_' || r.model_type AND v.run_id = r.run_id)"""

FLAT_COLS = "experiment, run_id, start_time, model_type, rmse, lifecycle_stage"


@register("rg01_best_per_type_ticks",
          rounded(f"WITH {RUNS_SQL}\nSELECT {FLAT_COLS} FROM best", ["rmse"]), covers=("RG-01",))
def best_per_type_ticks(spark, sf_dir):
    return rg.best_per_type(active(tick_runs(spark, sf_dir)), G)


@register("rg02_global_best_ticks",
          rounded(f"""WITH {RUNS_SQL}
SELECT experiment, arg_min(run_id, (rmse, -epoch_us(start_time), run_id)) AS run_id,
       arg_min(model_type, (rmse, -epoch_us(start_time), run_id)) AS model_type, min(rmse) AS rmse,
       arg_min(start_time, (rmse, -epoch_us(start_time), run_id)) AS start_time
FROM act GROUP BY experiment""", ["rmse"]), covers=("RG-02",))
def global_best_ticks(spark, sf_dir):
    return rg.global_best(active(tick_runs(spark, sf_dir)), G)


@register("rg03_rank_finalists_ticks",
          rounded(f"WITH {RUNS_SQL}\nSELECT {FLAT_COLS}, rank, alias FROM ranked2", ["rmse"]), covers=("RG-03",))
def rank_finalists_ticks(spark, sf_dir):
    return tick_ranking(tick_runs(spark, sf_dir))


@register("rg04_champion_verdict_ticks",
          rounded(f"""WITH {RUNS_SQL},
bl AS (SELECT 'exp_' || CAST(symbol % 10 AS VARCHAR) AS experiment, sqrt(avg(pow(actual - pred, 2))) AS baseline_rmse,
              avg(CASE WHEN sign(actual) = sign(pred) THEN 1.0 ELSE 0.0 END) AS baseline_da
       FROM preds WHERE model = 'naive' GROUP BY 1)
SELECT r.experiment, r.run_id, r.model_type, r.rmse, bl.baseline_rmse, bl.baseline_da,
       CASE WHEN r.rmse < bl.baseline_rmse THEN 'beats_baseline' ELSE 'worse_than_baseline' END AS verdict
FROM ranked2 r LEFT JOIN bl ON r.experiment = bl.experiment WHERE r.rank = 1""",
                  ["rmse", "baseline_rmse", "baseline_da"]), covers=("RG-04",))
def champion_verdict_ticks(spark, sf_dir):
    t = forecast.naive_prediction(train.tick_training_frame(spark, sf_dir)).filter(F.col("split") == "test")
    t = t.withColumn("experiment", F.concat(F.lit("exp_"), (F.col("symbol") % 10).cast("string")))
    base = t.groupBy("experiment").agg(M.rmse("actual", "pred").alias("baseline_rmse"),
                                       M.directional_accuracy("actual", "pred").alias("baseline_da"))
    v = rg.champion_verdict(tick_ranking(tick_runs(spark, sf_dir)), base, G)
    return v.select("experiment", "run_id", "model_type", "rmse", "baseline_rmse", "baseline_da", "verdict")


@register("rg05_best_vs_latest_ticks",
          rounded(f"""WITH {RUNS_SQL},
lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment, model_type
                                                   ORDER BY start_time DESC, run_id DESC) AS rn FROM act) WHERE rn = 1)
SELECT b.experiment, b.model_type, b.run_id AS best_run_id, b.rmse AS best_rmse, lt.run_id AS latest_run_id,
       lt.rmse AS latest_rmse, b.run_id = lt.run_id AS latest_is_best
FROM best b JOIN lt ON b.experiment = lt.experiment AND b.model_type = lt.model_type""",
                  ["best_rmse", "latest_rmse"]), covers=("RG-05",))
def best_vs_latest_ticks(spark, sf_dir):
    return rg.best_vs_latest(active(tick_runs(spark, sf_dir)), G)


@register("rg06_top_by_alias_ticks",
          f"""WITH {RUNS_SQL},
fa AS (SELECT * FROM (SELECT a.*, CASE alias WHEN 'champion' THEN 0 WHEN 'challenger' THEN 1 ELSE 2 END AS alias_rank,
                             row_number() OVER (PARTITION BY experiment, alias ORDER BY name) AS rn
                      FROM aliases a WHERE alias IN ('champion', 'challenger', 'candidate')) WHERE rn = 1)
SELECT fa.experiment, fa.alias, CAST(fa.alias_rank AS BIGINT) AS alias_rank, fa.name, fa.version, v.run_id
FROM fa LEFT JOIN versions v ON fa.experiment = v.experiment AND fa.name = v.name AND fa.version = v.version""",
          covers=("RG-06", "JN-06"))
def top_by_alias_ticks(spark, sf_dir):
    r = tick_runs(spark, sf_dir)
    v = tick_versions(r)
    return rg.top_by_alias(tick_aliases(r, v), v, G)


@register("rg07_resolve_alias_ticks",
          f"""WITH {RUNS_SQL},
pr AS (SELECT * FROM (VALUES ('challenger', 0), ('champion', 1), ('challenger', 2), ('candidate', 3)) t(alias, prio)),
c AS (SELECT a.experiment, a.name, a.version, pr.prio, a.alias AS via FROM aliases a JOIN pr ON a.alias = pr.alias
      UNION ALL SELECT experiment, name, max(version), 4, 'latest' FROM versions GROUP BY experiment, name)
SELECT experiment, name, arg_min(version, prio) AS version, arg_min(via, prio) AS via FROM c GROUP BY experiment, name""",
          covers=("RG-07",))
def resolve_alias_ticks(spark, sf_dir):
    r = tick_runs(spark, sf_dir)
    v = tick_versions(r)
    return rg.resolve_alias(tick_aliases(r, v), v, G, pointer_alias="challenger")


@register("rg08_versions_matching_ticks",
          rounded(f"""WITH {RUNS_SQL}
SELECT v.experiment, v.name, v.run_id, v.version, r.directional_accuracy FROM versions v
JOIN runs r ON v.experiment = r.experiment AND v.run_id = r.run_id
WHERE r.lifecycle_stage <> 'deleted' AND r.directional_accuracy > 0.6""", ["directional_accuracy"]),
          covers=("RG-08",))
def versions_matching_ticks(spark, sf_dir):
    r = tick_runs(spark, sf_dir)
    return rg.versions_matching(tick_versions(r), r, rg.metric("directional_accuracy") > F.lit(0.6), G)


@register("rg09_orphan_versions_ticks",
          f"""WITH {RUNS_SQL}
SELECT v.experiment, v.name, v.run_id, v.version FROM versions v
WHERE NOT EXISTS (SELECT 1 FROM act WHERE act.experiment = v.experiment AND act.run_id = v.run_id)""",
          covers=("RG-09", "JN-07"))
def orphan_versions_ticks(spark, sf_dir):
    r = tick_runs(spark, sf_dir)
    return rg.orphan_versions(tick_versions(r), r, G)


@register("rg10_stale_sample_runs_ticks",
          f"""WITH {RUNS_SQL}
SELECT symbol, run_id, model_type, CAST(logged_train_size AS BIGINT) AS logged_train_size,
       CAST(n_train AS BIGINT) AS n_train FROM runs WHERE logged_train_size <> n_train""",
          covers=("RG-10",))
def stale_sample_runs_ticks(spark, sf_dir):
    r = tick_runs(spark, sf_dir)
    current = train.tick_training_frame(spark, sf_dir).filter(F.col("split") == "train").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_train"))
    return rg.stale_sample_runs(r.drop("n_train"), current)


@register("rg11_top_runs_by_rmse_ticks",
          rounded(f"""WITH {RUNS_SQL}
SELECT * FROM (SELECT experiment, run_id, start_time, model_type, rmse, mae, CAST(NULL AS DOUBLE) AS r2, lifecycle_stage,
                      CAST(row_number() OVER (PARTITION BY experiment ORDER BY rmse NULLS LAST, run_id) AS BIGINT) AS pos
               FROM act) WHERE pos <= 5""", ["rmse", "mae", "r2"]), covers=("RG-11",))
def top_runs_by_rmse_ticks(spark, sf_dir):
    return rg.top_runs(active(tick_runs(spark, sf_dir)), 5, G)


@register("rg11_top_runs_recent_ticks",
          rounded(f"""WITH {RUNS_SQL}
SELECT * FROM (SELECT experiment, run_id, start_time, model_type, rmse, mae, CAST(NULL AS DOUBLE) AS r2, lifecycle_stage,
                      CAST(row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS BIGINT) AS pos
               FROM act) WHERE pos <= 5""", ["rmse", "mae", "r2"]), covers=("RG-11",))
def top_runs_recent_ticks(spark, sf_dir):
    return rg.top_runs(active(tick_runs(spark, sf_dir)), 5, G, recent=True)


@register("rg12_repoint_aliases_ticks",
          f"""WITH {RUNS_SQL},
fa AS (SELECT * FROM (SELECT a.*, row_number() OVER (PARTITION BY experiment, alias ORDER BY name) AS rn
                      FROM aliases a WHERE alias IN ('champion', 'challenger', 'candidate')) WHERE rn = 1),
nv AS (SELECT fa.experiment, fa.name, fa.alias, mv.v + 1 AS version FROM fa
       JOIN (SELECT experiment, name, max(version) AS v FROM versions GROUP BY experiment, name) mv
       ON fa.experiment = mv.experiment AND fa.name = mv.name),
u AS (SELECT experiment, name, alias, version, 0 AS p FROM aliases UNION ALL SELECT experiment, name, alias, version, 1 FROM nv)
SELECT experiment, name, alias, arg_max(version, p) AS version FROM u GROUP BY experiment, name, alias""",
          covers=("RG-12",))
def repoint_aliases_ticks(spark, sf_dir):
    r = checkpoint(tick_runs(spark, sf_dir))  # one small row per run, used by versions and ranking
    v = checkpoint(tick_versions(r))
    return rg.repoint_retrained(tick_aliases(r, v), v, G)
