"""Incremental ingest of newly arrived range files.

A file stream of lines feeds ``foreachBatch``; each micro-batch is parsed by name, as
in the batch loader, and upserted into a history table partitioned by series key and
year with **dynamic partition overwrite**, so a batch rewrites only what it touches.
Which row wins depends on the files' names alone, as in the batch load, so files may
arrive in any order (no watermark drops late ones). Re-running a batch writes the same
partitions with the same content, so the sink is idempotent and a restarted query
(same checkpoint) neither loses nor duplicates rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.operators.rows import dedupe_keep_last
from marketframe.session import checkpoint
from marketframe.sources import files

def _table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    # dynamic partition overwrite writes no root _SUCCESS marker: look for data folders
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))


def upsert_batch(batch: DataFrame, batch_id: int, table: str, keys: Sequence[str] = ("symbol", "Date"),
                 part: Sequence[str] = ("symbol",)) -> DataFrame:
    """Merge one micro-batch of parsed rows into ``table`` (Parquet partitioned by ``part`` and
    the year of the date key). Only the touched (series, year) partitions are read and
    rewritten, so a late bar in a huge series does not rewrite its whole history. Which row
    wins is :data:`files.PRECEDENCE`, as in the batch load, whatever the order of arrival.

    Returns the keys whose row the batch changed (``symbol, Date``), from the same pass."""
    spark = batch.sparkSession
    b = files.with_precedence(batch).withColumn("bucket_year", F.year(F.col(keys[1])))
    parts = [*part, "bucket_year"]
    b = b.withColumn("__new", F.lit(True))
    if _table_exists(spark, table):
        touched = b.select(*parts).distinct()
        old = spark.read.parquet(table).join(touched, parts, "left_semi")
        b = old.withColumn("__new", F.lit(False)).unionByName(b, allowMissingColumns=True)
    # equal precedence (a re-run of the batch) leaves the old row: nothing changes
    merged = dedupe_keep_last(b.withColumn("__old", ~F.col("__new")), tuple(keys), (*files.PRECEDENCE, "__old"))
    # materialise before overwriting partitions that the plan also reads
    merged = checkpoint(merged)
    (merged.drop("__new", "__old").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(table))
    return merged.where("__new").select(*keys)


def run_ingest(spark: SparkSession, source: str, table: str, checkpoint_location: str,
               value_columns: Sequence[str] = files.VALUE_COLUMNS, symbol_pattern: str = r"symbol=([^/]+)") -> None:
    """SS-01: process every file that arrived since the last run, then stop
    (``trigger(availableNow=True)``); progress lives in ``checkpoint_location``. Lines go
    through the batch loader's by-name parser (a file's lines are always in one batch), so
    vendor headers, reordered and missing columns load as there."""
    lines = spark.readStream.option("recursiveFileLookup", "true").text(source).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), "value")

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = files.parse_ragged(files.numbered(batch), value_columns)
        upsert_batch(rows.withColumn("symbol", F.regexp_extract("_file", symbol_pattern, 1)), batch_id, table)

    q = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location).trigger(
        availableNow=True).start()
    q.awaitTermination()


def changed_since(table_before: DataFrame, table_after: DataFrame, keys: Sequence[str] = ("symbol", "Date"),
                  value: str = "Close") -> DataFrame:
    """SS-02: per series the first date whose value changed (also to or from NULL),
    appeared or went away."""
    b = table_before.select(*keys, F.struct(F.col(value)).alias("__old"))
    a = table_after.select(*keys, F.struct(F.col(value)).alias("__now"))
    # a row that is not there has a NULL struct, a NULL value one with a NULL in it
    diff = a.join(b, list(keys), "full").where(~F.col("__old").eqNullSafe(F.col("__now")))
    return diff.groupBy(keys[0]).agg(F.min(keys[1]).alias("first_changed"))


def recompute_from(table: DataFrame, changed: DataFrame, feature_fn, lookback: int,
                   key: str = "symbol", order: str = "Date") -> DataFrame:
    """SS-02: recompute features only for touched series and only from the first
    changed row on; ``lookback`` earlier rows are read as context (halo) so windows
    are exact, then dropped."""
    t = table.join(changed, key, "inner")
    w = Window.partitionBy(key).orderBy(order)
    pos = F.row_number().over(w)
    t = t.withColumn("__pos", pos)
    first_pos = F.min(F.when(F.col(order) >= F.col("first_changed"), F.col("__pos"))).over(Window.partitionBy(key))
    t = t.withColumn("__first", first_pos)
    ctx = t.filter(F.col("__pos") >= F.col("__first") - lookback)
    out = feature_fn(ctx)
    return out.filter(F.col(order) >= F.col("first_changed")).drop("__pos", "__first", "first_changed")


#: Partitions of a table that are pruned by a broadcast list; beyond that, by a join.
LISTED = 100_000


def needed_partitions(table: DataFrame, changed: DataFrame, lookback: int) -> DataFrame:
    """SS-02: the ``(symbol, bucket_year)`` partitions that recomputing from ``first_changed`` reads: those of its year and after, and
    as many years before as hold ``lookback`` rows, by the rows of each partition (footers of the changed series only)."""
    # the comparison tells Spark that the list is worth pruning partitions by
    since = changed.where(F.col("first_changed") >= F.lit("0001-01-01")).select("symbol", F.year("first_changed").alias("from_year"))
    if changed.count() <= LISTED:
        since = F.broadcast(since)
    counts = table.join(since, "symbol").groupBy("symbol", "bucket_year", "from_year").agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy("symbol").orderBy(F.desc("bucket_year")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.when(F.col("bucket_year") < F.col("from_year"), F.col("rows")).otherwise(F.lit(0))
    nearer = checkpoint(counts.withColumn("nearer", F.coalesce(F.sum(earlier).over(w), F.lit(0))))
    return nearer.where((F.col("bucket_year") >= F.col("from_year")) | (F.col("nearer") < F.lit(lookback))).select("symbol", "bucket_year", "from_year")


def recompute_partitions(spark: SparkSession, table: str, features: str, changed: DataFrame, feature_fn, lookback: int, columns: Sequence[str] = ("Close",)) -> None:
    """SS-02 on tables partitioned by (symbol, year): features of the changed series from their first changed row on, into the table
    ``features``. Reads the partitions of :func:`needed_partitions` and no others, and rewrites only those of the first changed year and
    after; rows of that year before the change stay as they are. Repeating it gives the same table."""
    changed = checkpoint(changed.select("symbol", "first_changed"))
    history = spark.read.parquet(table)
    need = needed_partitions(history, changed, lookback)
    # a series is read from one year on; series of one such year are read together, so that partitions are pruned by year and by series
    floors = checkpoint(need.groupBy("symbol").agg(F.min("bucket_year").alias("floor")))
    small = floors.count() <= LISTED
    context = None
    for r in floors.select("floor").distinct().orderBy("floor").collect():  # at most one for each year
        some = floors.where(F.col("floor") == r["floor"]).select("symbol")
        part = history.where(F.col("bucket_year") >= r["floor"]).select("symbol", "Date", *columns).join(F.broadcast(some) if small else some, "symbol", "left_semi")
        context = part if context is None else context.unionByName(part)
    if context is None:
        return
    fresh = feature_fn(context).join(changed, "symbol").where(F.col("Date") >= F.col("first_changed")).drop("first_changed")
    fresh = fresh.withColumn("bucket_year", F.year("Date"))
    if _table_exists(spark, features):
        kept = need.where(F.col("bucket_year") == F.col("from_year")).select("symbol", "bucket_year")
        before = spark.read.parquet(features).join(F.broadcast(kept) if small else kept, ["symbol", "bucket_year"], "left_semi")
        before = before.join(changed, "symbol").where(F.col("Date") < F.col("first_changed")).drop("first_changed")
        fresh = fresh.unionByName(before)
    fresh = checkpoint(fresh)  # the plan also reads partitions that it overwrites
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "bucket_year").parquet(features)
