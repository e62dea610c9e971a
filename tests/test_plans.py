"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from marketframe.plans import train
from tests.conftest import SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_stack_and_split_share_one_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = train.tick_training_frame(spark, SMALL)
        text = plan_text(df)
        assert text.count("Exchange hashpartitioning") == 1
        assert "Exchange hashpartitioning(symbol" in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_prunes_columns_and_pushes_filter(spark):
    from marketframe.sources import panels
    df = panels.ticks(spark, SMALL).filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThan(value,0.0)" in text
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_dedupe_is_partial_aggregate(spark):
    from marketframe.plans.q_prep import dedupe_keep_last_ticks
    text = plan_text(dedupe_keep_last_ticks.__wrapped__(spark, SMALL)) if hasattr(
        dedupe_keep_last_ticks, "__wrapped__") else plan_text(dedupe_keep_last_ticks(spark, SMALL))
    assert "partial_max_by" in text or "partial_" in text


def test_scoring_plans_without_running_jobs(spark):
    from marketframe.operators import linear, scale
    t = train.bar_training_frame(spark, SMALL)
    spark.sparkContext.setJobGroup("planning", "")
    coefs = linear.fit_linear(t.filter(F.col("split") == "train"), ["ret"], "target", ["symbol"])
    scored = linear.score_linear(t.filter(F.col("split") == "test"), coefs, ["ret"])
    scaled = scale.transform_minmax(t, ["ret"], scaler=scale.fit_minmax(t, ["ret"]), keys=["symbol"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setJobGroup("running", "")
    assert scored.filter(F.col("pred").isNull()).count() == 0
    assert scaled.count() == t.count()


def test_readers_split_files_and_compaction_needs_no_nested_loop(spark, tmp_path):
    from marketframe.sources import files
    (tmp_path / "data_2024-01-02_from_2024-01-01.csv").write_text("Date,Close\n2024-01-01,1\n2024-01-02,2\n")
    # (pushed into the scan, the whole-text option would show as one row per file)
    assert files.read_lines(spark, str(tmp_path)).count() == 3
    assert "NestedLoop" not in plan_text(files.superseded(files.catalog(spark, str(tmp_path))))
    assert "content" not in plan_text(files.catalog(spark, str(tmp_path))).split("ReadSchema")[-1]
