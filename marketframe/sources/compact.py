"""IO-13: removal of superseded range files under readers.

A file whose range lies inside another's may still hold the rows that win in a load (last name wins), so
removing it alone changes what is loaded. Compaction therefore goes in steps, each of which leaves every load as it was:

1. the winning rows of all range files of the series concerned are written to a hidden folder,
2. counted again, and renamed into sight in one step: new rows equal the winners, so they change nothing,
3. listed again, and only then the old files go, the lowest in precedence first: as long as any of a date's rows is there, its winner is.

A run that fails at any step is repeated: hidden leftovers are removed, visible ones are files like any other.
Dates that only merged files have stay there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.operators.rows import dedupe_keep_last
from marketframe.session import checkpoint
from marketframe.sources import files

HIDDEN, VISIBLE = "_compact-", "compact-"


def _rows(spark: SparkSession, paths, value_columns: Sequence[str]) -> DataFrame:
    r = files.read_ragged(spark, paths, value_columns)
    return r.withColumn("symbol", F.regexp_extract("_file", r"symbol=([^/]+)", 1))


def compact(spark: SparkSession, root: str, value_columns: Sequence[str] = files.VALUE_COLUMNS, step: Callable[[str], None] = lambda name: None) -> int:
    """Compacts the series below ``root`` that have superseded files; returns the number of files removed. ``step``
    is called after each step."""
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in fs.listStatus(path(root)):
        if entry.getPath().getName().startswith(HIDDEN):
            fs.delete(entry.getPath(), True)
    listed = files.catalog(spark, root).withColumn("symbol", F.regexp_extract("path", r"symbol=([^/]+)", 1))
    listed = checkpoint(listed.where("name IS NOT NULL"))
    series = files.superseded(listed, ["symbol"]).select("symbol").distinct()
    old = checkpoint(listed.join(series, "symbol", "left_semi").select("symbol", "name", "path"))
    if old.isEmpty():
        return 0
    rows = _rows(spark, root, value_columns).join(old.select(F.col("path").alias("_file")), "_file", "left_semi")
    won = checkpoint(dedupe_keep_last(files.with_precedence(rows), ("symbol", "Date"), files.PRECEDENCE).select("symbol", "Date", *value_columns))
    ranges = won.groupBy("symbol").agg(files.range_name(F.min("Date"), F.max("Date")).alias("range"))
    name = uuid.uuid4().hex[:12]
    hidden, visible = f"{root.rstrip('/')}/{HIDDEN}{name}", f"{root.rstrip('/')}/{VISIBLE}{name}"
    won.join(ranges, "symbol").write.partitionBy("symbol", "range").option("header", True).csv(hidden)
    step("written")
    wanted = won.count()
    if _rows(spark, hidden, value_columns).count() != wanted:
        raise OSError(f"{hidden} doesn't hold the {wanted} rows that were written")
    if not fs.rename(path(hidden), path(visible)):
        raise OSError(f"can't rename {hidden}")
    step("visible")
    if _rows(spark, visible, value_columns).count() != wanted:
        raise OSError(f"{visible} isn't listed with its {wanted} rows; nothing is removed")
    step("listed")
    removed = 0
    for r in old.orderBy("name", "path").toLocalIterator():  # names only, a partition at a time
        fs.delete(path(r["path"]), False)
        removed += 1
        step("removed")
    return removed
