"""File sources and sinks.

* Range-named partitions ``data_{end}_from_{start}`` are written by Spark (one
  directory per range, ``partitionBy`` over a derived range column) and listed
  back through ``_metadata.file_path`` - the catalog is a DataFrame.
* Ragged CSVs (different column sets/orders, vendor 3-line headers, stringified
  tuple names) are parsed **by name**, line by line, so large files split over tasks:
  each file's header line (one small row) joins its data lines by file, and a column is
  taken at its place in that header. Meta lines drop out because their first field is
  not a date. Spark's positional multi-file CSV read would silently swap columns
  between files with different orders. Batch and stream share this parser.
* Compaction is one sort per key: a file is superseded when a file before it in order
  of (start, end descending) reaches at least as far.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators.rows import dedupe_keep_last

# Fixed values that must equal the reference for equal results.
RANGE_PATTERN = r"data_(\d{4}-\d{2}-\d{2})_from_(\d{4}-\d{2}-\d{2})"
MERGED_NAME = "merged"
DATE_HEADERS = ("Date", "Price")          # first header cell of a data file
VALUE_COLUMNS = ("Close", "High", "Low", "Open", "Volume")

TUPLE_NAME = r"""^\(\s*(?:'([^']*)'|"([^"]*)")\s*,.*\)$"""
CELL_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)(?![^(]*\))'  # a comma outside quotes and parentheses

OHLCV_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()), T.StructField("Close", T.DoubleType()),
    T.StructField("High", T.DoubleType()), T.StructField("Low", T.DoubleType()),
    T.StructField("Open", T.DoubleType()), T.StructField("Volume", T.DoubleType())])


# ------------------------------------------------------------------ names
def clean_column_name(name: str) -> str:
    """IO-04: ``('Close', 'EURUSD=X')`` -> ``Close``, with either kind of quotes and also
    when the whole cell is quoted; plain names are trimmed."""
    s = name.strip()
    if len(s) > 1 and s[0] == s[-1] == '"':
        s = s[1:-1].replace('""', '"').strip()
    m = re.match(TUPLE_NAME, s)
    return (m.group(1) if m.group(1) is not None else m.group(2)) if m else s


def dedupe_columns(df: DataFrame) -> DataFrame:
    """IO-05: keep the first of several columns with the same (cleaned) name."""
    seen, cols = set(), []
    for i, c in enumerate(df.columns):
        name = clean_column_name(c)
        if name in seen:
            continue
        seen.add(name)
        cols.append(F.col(f"`{c}`").alias(name))
    return df.select(*cols)


def flatten_two_level(df: DataFrame, date_col: str = "Date", sep: str = "|") -> DataFrame:
    """IO-06: wide ``field|ticker`` columns (two-level header flattened with ``sep``)
    to a long panel ``(symbol, Date, Close, High, ...)``: unpivot, split, pivot."""
    value_cols = [c for c in df.columns if c != date_col]
    long = df.unpivot([date_col], value_cols, "__name", "__value")
    parts = F.split("__name", re.escape(sep), 2)
    long = long.select(date_col, parts[0].alias("__field"), parts[1].alias("symbol"),
                       F.col("__value").cast("double").alias("__value"))
    fields = sorted({c.split(sep, 1)[0] for c in value_cols})
    return long.groupBy("symbol", date_col).pivot("__field", fields).agg(F.first("__value"))


# ------------------------------------------------------------------ reading
def read_csv(spark: SparkSession, paths, schema: T.StructType = OHLCV_SCHEMA) -> DataFrame:
    """IO-01: CSV with a header row and an explicit schema, plus the source path.
    Use for files that share one column layout."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(paths)
    return df.withColumn("_file", F.url_decode(F.col("_metadata.file_path")))


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of all files below ``paths``: ``_file, _row`` (its order within the file), ``value``."""
    return numbered(spark.read.option("recursiveFileLookup", "true").text(paths).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), "value"))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their order in the file: the block's offset, then the order of reading."""
    return lines.select(F.url_decode("_path").alias("_file"), F.struct(
        F.col("_block").alias("block"), F.monotonically_increasing_id().alias("line")).alias("_row"), "value")


def parse_ragged(lines: DataFrame, value_columns: Sequence[str] = VALUE_COLUMNS) -> DataFrame:
    """IO-02/IO-03 on lines (``_file, _row, value``): ``_file, _row, Date, <value_columns>...``.

    A file's header is its first line that starts with ``Price`` or, without one, with
    ``Date``; its cells are cleaned (IO-04), and of equal names the first counts (IO-05)."""
    value = F.regexp_replace("value", "\r", "")
    first = _clean_name_col(F.element_at(F.split(value, CELL_COMMA, 2), 1))
    is_header = first.isin(*DATE_HEADERS)
    heads = lines.withColumn("__first", first).where(is_header).groupBy("_file").agg(
        F.min_by(value, F.struct(F.when(F.col("__first") == "Price", 0).otherwise(1), "_row")).alias("__h"))
    heads = heads.select("_file", F.transform(F.split("__h", CELL_COMMA), _clean_name_col).alias("__hdr"))
    fields = F.split(value, CELL_COMMA)
    cell = F.btrim(F.element_at(fields, 1), F.lit(' "'))
    date = F.to_date(F.coalesce(F.try_to_timestamp(cell, F.lit("yyyy-MM-dd")),
                                F.try_to_timestamp(cell, F.lit("yyyy-MM-dd HH:mm:ss"))))
    body = lines.select("_file", "_row", date.alias("Date"), fields.alias("__f")).where(F.col("Date").isNotNull())

    def column(c: str) -> Column:
        at = F.array_position("__hdr", c)
        text = F.when(at > 0, F.get("__f", (at - 1).cast("int")))
        return F.btrim(text, F.lit(' "')).try_cast("double").alias(c)

    return body.join(heads, "_file").select("_file", "_row", "Date", *[column(c) for c in value_columns])


def read_ragged(spark: SparkSession, paths, value_columns: Sequence[str] = VALUE_COLUMNS) -> DataFrame:
    """IO-02/IO-03: load files with differing headers by name.

    Output ``(_file, _row, Date, <value_columns>...)`` with values coerced to DOUBLE
    (bad -> NULL). Files whose header lacks a column yield NULL for it; lines without a
    date (headers, the vendor's meta lines) drop out, and so do files without a header.
    """
    return parse_ragged(read_lines(spark, paths), value_columns)


def _clean_name_col(c: Column) -> Column:
    """Column twin of :func:`clean_column_name`."""
    t = F.trim(c)
    t = F.when(t.rlike('^".*"$'), F.trim(F.replace(F.regexp_replace(t, '^"|"$', ""), F.lit('""'), F.lit('"')))).otherwise(t)
    tup = F.coalesce(F.nullif(F.regexp_extract(t, TUPLE_NAME, 1), F.lit("")), F.nullif(F.regexp_extract(t, TUPLE_NAME, 2), F.lit("")))
    return F.coalesce(tup, t)


def with_precedence(rows: DataFrame) -> DataFrame:
    """The one order of writers, for batch and stream: the merged file lowest, then range
    names ascending (``_prec, _name``), then ``_file`` and ``_row``."""
    return rows.withColumns({"_prec": F.when(F.col("_file").contains(MERGED_NAME), F.lit(0)).otherwise(F.lit(1)),
                             "_name": F.regexp_extract("_file", RANGE_PATTERN, 0)})


PRECEDENCE = ("_prec", "_name", "_file", "_row")


def load_history(spark: SparkSession, paths, symbol: Column | str | None = None,
                 value_columns: Sequence[str] = VALUE_COLUMNS) -> DataFrame:
    """IO-03 + SL-01: all range files and the merged file, parsed by name, one row
    per (symbol, date) with last-write-wins precedence: the merged file lowest, then
    file name ascending, then row in file. ``symbol`` derives the series key from the
    path (default: ``symbol=...`` partition folder, else one series)."""
    r = read_ragged(spark, paths, value_columns)
    if symbol is None:
        sym = F.regexp_extract("_file", r"symbol=([^/]+)", 1)
    else:
        sym = F.col(symbol) if isinstance(symbol, str) else symbol
    r = r.withColumn("symbol", sym)
    d = dedupe_keep_last(with_precedence(r), ("symbol", "Date"), PRECEDENCE)
    return d.drop("_prec", "_name")


# ------------------------------------------------------------------ writing
def range_name(start: Column, end: Column) -> Column:
    return F.concat(F.lit("data_"), F.date_format(end, "yyyy-MM-dd"), F.lit("_from_"),
                    F.date_format(start, "yyyy-MM-dd"))


def write_range_partitions(df: DataFrame, path: str, bucket: Column, keys: Sequence[str] = ("symbol",),
                           date_col: str = "Date", fmt: str = "csv") -> DataFrame:
    """IO-07: write each (keys, bucket) slice under a folder named by its actual
    date range ``data_{max}_from_{min}`` (a window over the slice computes the range;
    ``partitionBy`` writes the folders in parallel). Returns the written frame."""
    w = Window.partitionBy(*keys, bucket)
    d = df.withColumns({"__lo": F.min(date_col).over(w), "__hi": F.max(date_col).over(w)})
    d = d.withColumn("range", range_name(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
    writer = d.write.mode("overwrite").partitionBy(*keys, "range")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return d


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path`` by renaming; the old folder
    goes only after that, so a failed write or rename loses nothing."""
    jvm = spark.sparkContext._jvm
    at, fresh, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, f"{new}-old"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"can't move {path}")
    if not fs.rename(fresh, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"can't move {new}")
    if had:
        fs.delete(old, True)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_merged(df: DataFrame, path: str, keys: Sequence[str] = ("symbol",), fmt: str = "parquet") -> None:
    """IO-08: full-history write partitioned by series key: a new folder beside the target,
    then :func:`swap_in`. ``df`` may read the target."""
    new = f"{path.rstrip('/')}-new-{uuid.uuid4().hex[:12]}"
    try:
        df.write.partitionBy(*keys).format(fmt).option("header", True).save(new)
        swap_in(df.sparkSession, new, path)
    except Exception:
        _delete(df.sparkSession, new)
        raise


def save_processed(frame: DataFrame, scaler: DataFrame, path: str, split_col: str = "split") -> None:
    """IO-09: processed features partitioned by split, and the scaler table; both are
    written in full before they take the old ones' places."""
    new = f"{path.rstrip('/')}-new-{uuid.uuid4().hex[:12]}"
    frame.write.partitionBy(split_col).parquet(f"{new}/features")
    scaler.write.parquet(f"{new}/scaler")
    swap_in(frame.sparkSession, new, path)


def load_processed(spark: SparkSession, path: str, split: str | None = None) -> tuple[DataFrame, DataFrame]:
    """IO-10: read back features (partition-pruned to one split) and the scaler."""
    f = spark.read.parquet(f"{path}/features")
    if split is not None:
        f = f.filter(F.col("split") == split)
    return f, spark.read.parquet(f"{path}/scaler")


def metadata_sidecar(frame: DataFrame, features: Sequence[str], path: str | None = None,
                     split_col: str = "split") -> DataFrame:
    """IO-11: one-row metadata (row counts per split, date range, feature list) as a
    DataFrame; written as JSON when ``path`` is given."""
    meta = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(split_col) == "train").alias("train_rows"),
        F.count_if(F.col(split_col) == "test").alias("test_rows"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    ).withColumn("features", F.array(*[F.lit(f) for f in features]))
    if path:
        meta.coalesce(1).write.mode("overwrite").json(path)
    return meta


# ------------------------------------------------------------------ catalog
def catalog(spark: SparkSession, paths) -> DataFrame:
    """IO-12: one row per range-named file ``(path, name, start, end)``; files
    without a range in their path are the merged/legacy ones (start/end NULL)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    # the content column is pruned: only the listing is read
    return files_catalog(files.select(F.url_decode(F.col("_metadata.file_path")).alias("path")))


def files_catalog(files: DataFrame, path_col: str = "path") -> DataFrame:
    name = F.regexp_extract(path_col, RANGE_PATTERN, 0)
    return files.select(
        F.col(path_col).alias("path"), F.when(name != "", name).alias("name"),
        F.to_date(F.nullif(F.regexp_extract(path_col, RANGE_PATTERN, 2), F.lit(""))).alias("start"),
        F.to_date(F.nullif(F.regexp_extract(path_col, RANGE_PATTERN, 1), F.lit(""))).alias("end"))


def latest_date(cat: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """IO-12: latest covered date = max(end) over the catalog."""
    return cat.groupBy(*by).agg(F.max("end").alias("latest"))


def superseded(cat: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """IO-13 / JN-08: files whose range lies inside another file's range
    (``old.start >= new.start and old.end <= new.end``, self excluded; of two equal
    ranges the lexically smaller path is superseded). Files without a range are left out.

    In order of (start, end descending, path descending) every file that contains another
    comes before it, so one running maximum of ``end`` per key decides; without ``by`` the
    catalog (one row per file) is one group."""
    ranged = cat.where(F.col("start").isNotNull() & F.col("end").isNotNull())
    before = Window.partitionBy(*by).orderBy("start", F.desc("end"), F.desc("path")).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("__reach", F.max("end").over(before)).where(F.col("__reach") >= F.col("end")).drop("__reach")


# ------------------------------------------------------------------ JSON
CONFIG_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StringType())), T.StructField("target", T.StringType()),
    T.StructField("model_type", T.StringType()), T.StructField("time_steps", T.IntegerType()),
    T.StructField("n_features", T.IntegerType())])

POINTER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("model_type", T.StringType()),
    T.StructField("model_name", T.StringType()), T.StructField("model_version", T.StringType()),
    T.StructField("model_alias", T.StringType()), T.StructField("model_uri", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField("rmse", T.DoubleType())])),
    T.StructField("baseline_metrics", T.StructType([T.StructField("rmse", T.DoubleType()),
                                                    T.StructField("directional_accuracy", T.DoubleType())]))])


def read_json(spark: SparkSession, paths, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """IO-14: nested JSON documents (configs, champion pointers) with an explicit
    schema; ``multi_line`` so pretty-printed files parse, else one document a line."""
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(paths).withColumn(
        "_file", F.url_decode(F.col("_metadata.file_path")))


def parse_json_column(df: DataFrame, col: str, schema: T.StructType, out: str = "parsed") -> DataFrame:
    """IO-14: decode a JSON text column."""
    return df.withColumn(out, F.from_json(col, schema))
