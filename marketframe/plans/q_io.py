"""Registered queries: file sources and sinks. Each query writes data Spark derives
from the driver tables into a fresh folder under ``spark.checkpoint.dir`` and reads
it back through the loaders under test."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketframe.operators import forecast, scale
from marketframe.plans import train
from marketframe.plans.q_bars import BAR_TRAIN_SQL
from marketframe.plans.q_runs import RUNS_SQL
from marketframe.plans.registry import DAILY, ORACLE, register, rounded
from marketframe.session import scratch_dir
from marketframe.sources import files, panels

HALF_YEAR_START = "2001-02-01"


def daily_dates(spark, sf_dir):
    d = panels.daily(spark, sf_dir)
    return d.select("symbol", F.to_date("ts").alias("Date"), F.col("close").alias("Close"))


def write_history_files(spark, sf_dir, root: str) -> None:
    """Fixture writer: per series a merged file (``Date,Close``), yearly range files
    with the vendor 3-line header (values x1.01, columns in a different order) and a
    later half-year range file (``Date,Close``, values x1.02)."""
    d = daily_dates(spark, sf_dir)
    # merged full history, plain header, lowest precedence
    d.write.mode("overwrite").partitionBy("symbol").option("header", True).csv(f"{root}/merged")
    # yearly vendor files: header lines carry order 0..2, data lines follow
    y = d.withColumn("__year", F.year("Date"))
    w = Window.partitionBy("symbol", "__year")
    y = y.withColumn("range", files.range_name(F.min("Date").over(w), F.max("Date").over(w)))
    c = F.col("Close") * 1.01
    data = y.select("symbol", "range", F.lit(3).alias("__o"), F.col("Date").alias("__d"),
                    F.concat_ws(",", F.date_format("Date", "yyyy-MM-dd"), c.cast("string"),
                                c.cast("string"), c.cast("string"), c.cast("string"), F.lit("0.0")).alias("value"))
    heads = y.select("symbol", "range").distinct()
    hdr = heads.select("symbol", "range", F.explode(F.array(
        F.struct(F.lit(0).alias("__o"), F.lit("Price,Open,Close,High,Low,Volume").alias("value")),
        F.struct(F.lit(1).alias("__o"), F.lit("Ticker,X,X,X,X,X").alias("value")),
        F.struct(F.lit(2).alias("__o"), F.lit("Date,,,,,").alias("value")))).alias("h")).select(
        "symbol", "range", "h.__o", F.lit(None).cast("date").alias("__d"), "h.value")
    lines = hdr.unionByName(data).repartition("symbol", "range").sortWithinPartitions("symbol", "range", "__o", "__d")
    lines.select("symbol", "range", "value").write.mode("overwrite").partitionBy("symbol", "range").text(
        f"{root}/ranges")
    # a later half-year file that revises the last months
    h = d.filter(F.col("Date") >= F.lit(HALF_YEAR_START))
    wh = Window.partitionBy("symbol")
    h = h.withColumn("range", files.range_name(F.min("Date").over(wh), F.max("Date").over(wh)))
    h = h.withColumn("Close", F.col("Close") * 1.02)
    h.repartition("symbol", "range").sortWithinPartitions("Date").write.mode("overwrite").partitionBy(
        "symbol", "range").option("header", True).csv(f"{root}/updates")


HISTORY_SQL = f"""WITH {DAILY},
d AS (SELECT symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS Date, close FROM daily)
SELECT symbol, Date, CASE WHEN Date >= TIMESTAMP '{HALF_YEAR_START} 00:00:00' THEN close * 1.02 ELSE close * 1.01 END
       AS Close FROM d"""


@register("io03_ragged_history_load_daily", rounded(HISTORY_SQL, ["Close"]),
          covers=("IO-01", "IO-02", "IO-03", "IO-04", "IO-05", "SL-01", "JN-10", "IO-18"))
def ragged_history_load_daily(spark, sf_dir):
    """Merged + vendor-header + two-column files, parsed by name, keep-last merged."""
    root = scratch_dir(spark, "history")
    write_history_files(spark, sf_dir, root)
    h = files.load_history(spark, [f"{root}/merged", f"{root}/ranges", f"{root}/updates"])
    return h.select("symbol", "Date", "Close")


CATALOG_SQL = f"""WITH {DAILY},
y AS (SELECT symbol, year(ts) AS yr, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM daily GROUP BY 1, 2),
h AS (SELECT symbol, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM daily
      WHERE ts >= TIMESTAMP '{HALF_YEAR_START} 00:00:00' GROUP BY 1),
c AS (SELECT symbol, start, "end", n FROM y UNION ALL SELECT symbol, start, "end", n FROM h)
SELECT symbol, 'data_' || strftime("end", '%Y-%m-%d') || '_from_' || strftime(start, '%Y-%m-%d') AS name,
       start, "end", CAST(n AS BIGINT) AS rows FROM c"""


def history_catalog(spark, root):
    cat = files.catalog(spark, [f"{root}/ranges", f"{root}/updates"])
    cat = cat.withColumn("symbol", F.regexp_extract("path", r"symbol=([^/]+)", 1))
    return cat


@register("io12_file_catalog_daily", CATALOG_SQL, covers=("IO-07", "IO-12", "AU-11"))
def file_catalog_daily(spark, sf_dir):
    """Range-named files written by Spark, listed back as a catalog with row counts."""
    root = scratch_dir(spark, "catalog")
    write_history_files(spark, sf_dir, root)
    cat = history_catalog(spark, root).select("symbol", "path", "name", "start", "end").distinct()
    rows = files.read_ragged(spark, [f"{root}/ranges", f"{root}/updates"]).groupBy(
        F.col("_file").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    j = cat.join(rows, "path")
    return j.groupBy("symbol", "name", "start", "end").agg(F.sum("rows").alias("rows"))


@register("io13_superseded_files_daily",
          f"""WITH {DAILY},
h AS (SELECT symbol, min(ts) AS start, max(ts) AS "end" FROM daily
      WHERE ts >= TIMESTAMP '{HALF_YEAR_START} 00:00:00' GROUP BY 1)
SELECT symbol, 'data_' || strftime("end", '%Y-%m-%d') || '_from_' || strftime(start, '%Y-%m-%d') AS name,
       max("end") OVER (PARTITION BY symbol) AS latest FROM h""",
          covers=("IO-13", "JN-08", "IO-12"))
def superseded_files_daily(spark, sf_dir):
    """The half-year update lies inside the last yearly file, so it is superseded."""
    root = scratch_dir(spark, "compaction")
    write_history_files(spark, sf_dir, root)
    cat = history_catalog(spark, root).select("symbol", "name", "start", "end").distinct().withColumn(
        "path", F.col("name"))
    sup = files.superseded(cat, by=["symbol"])
    latest = files.latest_date(cat, ["symbol"])
    return sup.join(latest, "symbol").select("symbol", "name", "latest")


@register("io09_processed_roundtrip_bars",
          f"""WITH {BAR_TRAIN_SQL}
SELECT symbol, CAST(count(*) AS BIGINT) AS test_rows, CAST(16 AS BIGINT) AS scaler_features FROM bt
WHERE split = 'test' GROUP BY symbol""",
          covers=("IO-09", "IO-10", "IO-11"))
def processed_roundtrip_bars(spark, sf_dir):
    """Save the processed split (partitioned by split) and the scaler table, read the
    test partition back (partition pruning) and the scaler."""
    t = train.bar_training_frame(spark, sf_dir)
    feats = list(train.wn.EXTENDED_FEATURES)
    scaler = scale.fit_minmax(t, feats)
    root = scratch_dir(spark, "processed")
    files.save_processed(scale.transform_minmax(t, feats), scaler, root)
    files.metadata_sidecar(t, feats, f"{root}/metadata")
    test, sc = files.load_processed(spark, root, "test")
    n = test.groupBy("symbol").agg(F.count(F.lit(1)).alias("test_rows"))
    k = sc.groupBy("symbol").agg(F.count(F.lit(1)).alias("scaler_features"))
    return n.join(k, "symbol")


@register("io08_merged_write_daily",
          rounded(f"""WITH {DAILY}
SELECT symbol, CAST(count(*) AS BIGINT) AS rows, avg(close) AS mean_close FROM daily GROUP BY symbol""",
                  ["mean_close"]),
          covers=("IO-08",))
def merged_write_daily(spark, sf_dir):
    root = scratch_dir(spark, "merged")
    files.write_merged(panels.daily(spark, sf_dir), root)
    back = spark.read.parquet(root)
    return back.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.avg("close").alias("mean_close"))


@register("io14_champion_pointer_json_ticks",
          rounded(f"""WITH {RUNS_SQL},
bl AS (SELECT 'exp_' || CAST(symbol % 10 AS VARCHAR) AS experiment, sqrt(avg(pow(actual - pred, 2))) AS baseline_rmse,
              avg(CASE WHEN sign(actual) = sign(pred) THEN 1.0 ELSE 0.0 END) AS baseline_da
       FROM preds WHERE model = 'naive' GROUP BY 1)
SELECT r.run_id, r.model_type, 'model_' || r.model_type AS model_name, 'champion' AS model_alias,
       r.rmse AS rmse, bl.baseline_rmse AS baseline_rmse, bl.baseline_da AS baseline_da
FROM ranked2 r LEFT JOIN bl ON r.experiment = bl.experiment WHERE r.rank = 1""",
                  ["rmse", "baseline_rmse", "baseline_da"]),
          covers=("IO-14", "RG-04"))
def champion_pointer_json_ticks(spark, sf_dir):
    """Champion pointer records written as JSON text and read back with a nested schema."""
    from marketframe.operators import runs as rg
    from marketframe.plans import q_runs
    from marketframe.functions import metrics as M
    t = forecast.naive_prediction(train.tick_training_frame(spark, sf_dir)).filter(F.col("split") == "test")
    t = t.withColumn("experiment", F.concat(F.lit("exp_"), (F.col("symbol") % 10).cast("string")))
    base = t.groupBy("experiment").agg(M.rmse("actual", "pred").alias("baseline_rmse"),
                                       M.directional_accuracy("actual", "pred").alias("baseline_da"))
    v = rg.champion_verdict(q_runs.tick_ranking(q_runs.tick_runs(spark, sf_dir)), base, ["experiment"])
    root = scratch_dir(spark, "pointers")
    rg.pointer_json(v).select("pointer").write.mode("overwrite").text(root)
    back = files.read_json(spark, root, files.POINTER_SCHEMA, multi_line=False)
    return back.select("run_id", "model_type", "model_name", "model_alias", F.col("metrics.rmse").alias("rmse"),
                       F.col("baseline_metrics.rmse").alias("baseline_rmse"),
                       F.col("baseline_metrics.directional_accuracy").alias("baseline_da"))


@register("io13_compacted_load_daily", ORACLE["io03_ragged_history_load_daily"], covers=("IO-13", "IO-03", "JN-08"))
def compacted_load_daily(spark, sf_dir):
    """The load after its superseded files were removed is the load before."""
    from marketframe.sources import compact
    root = scratch_dir(spark, "compacted")
    write_history_files(spark, sf_dir, root)
    if not compact.compact(spark, root):
        raise AssertionError("the half-year update is superseded")
    return files.load_history(spark, root).select("symbol", "Date", "Close")
