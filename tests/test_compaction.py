"""Removal of superseded files that fails at any step, and recomputing features from the first changed row."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from marketframe.operators import features as wn
from marketframe.plans.q_stream import DATE_SPEC
from marketframe.sources import compact, files
from marketframe.streaming import ingest


def write(root, symbol, name, rows, header="Date,Close"):
    folder = f"{root}/symbol={symbol}/{name}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-0.csv", "w") as f:
        f.write("\n".join([header, *[f"{d},{v}" for d, v in rows]]) + "\n")


def day(i):
    return (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat()


def history(root):
    name = lambda a, b: f"data_{day(b)}_from_{day(a)}"
    write(root, "a", "merged", [(day(i), i) for i in range(0, 30)])
    write(root, "a", name(0, 9), [(day(i), 100 + i) for i in range(10)])
    write(root, "a", name(5, 9), [(day(i), 200 + i) for i in (5, 7, 9)])  # superseded, and its rows win
    write(root, "a", name(2, 4), [(day(i), 300 + i) for i in (2, 3, 4)])  # superseded, its rows lose
    write(root, "a", name(8, 14), [(day(i), 400 + i) for i in range(8, 15)])  # overlaps, not superseded
    write(root, "b", name(0, 3), [(day(i), 500 + i) for i in range(4)])  # nothing superseded
    write(root, "b", name(2, 6), [(day(i), 600.25 + i) for i in range(2, 7)])


def load(spark, root):
    return sorted((r.symbol, str(r.Date), r.Close) for r in files.load_history(spark, root).select("symbol", "Date", "Close").collect())


class Stop(Exception):
    pass


@pytest.mark.parametrize("fail_at", ["written", "visible", "listed", "removed", 2, 3, None])
def test_loads_agree_whatever_step_fails(spark, tmp_path, fail_at):
    root = str(tmp_path)
    history(root)
    want, seen = load(spark, root), []

    def step(name):
        seen.append(name)
        if name in ("written", "visible") or fail_at in (2, 3):
            assert load(spark, root) == want, seen
        if name == fail_at or seen.count("removed") == fail_at:
            raise Stop

    if fail_at is not None:
        with pytest.raises(Stop):
            compact.compact(spark, root, step=step)
        assert load(spark, root) == want
    removed = compact.compact(spark, root)
    assert load(spark, root) == want and removed >= (2 if fail_at == 3 else 4 - (fail_at or 0) if isinstance(fail_at, int) else 3)
    left = files.catalog(spark, root).withColumn("symbol", F.regexp_extract("path", r"symbol=([^/]+)", 1))
    assert not files.superseded(left, ["symbol"]).where("symbol = 'b'").count()
    assert len([p for p in glob.glob(f"{root}/symbol=b/**/*.csv", recursive=True)]) == 2
    assert not glob.glob(f"{root}/_compact-*") and not glob.glob(f"{root}/symbol=a/data_*/*.csv")


def feats(df):
    return wn.moving_averages(wn.returns(df, DATE_SPEC, col="Close"), (5,), DATE_SPEC, col="Close")


def test_recompute_reads_and_writes_what_the_change_needs(spark, tmp_path):
    table, out = f"{tmp_path}/table", f"{tmp_path}/features"
    # six years of twenty rows; one series has two rows a year, so that the look-back reaches over years
    rows = [(s, dt.date(2015 + y, 1 + k * 11 // n, 1 + k % 28), float(y * 100 + k * k % 17 + 1)) for s, n in (("a", 20), ("b", 20), ("few", 2)) for y in range(6) for k in range(n)]
    df = spark.createDataFrame(rows, "symbol string, Date date, Close double")
    df.withColumn("bucket_year", F.year("Date")).write.partitionBy("symbol", "bucket_year").parquet(table)
    first = df.groupBy("symbol").agg(F.min("Date").alias("first_changed"))
    ingest.recompute_partitions(spark, table, out, first, feats, 5)
    full = lambda: sorted(map(tuple, feats(spark.read.parquet(table).select("symbol", "Date", "Close")).select("symbol", "Date", "ret", "ma_5").collect()), key=repr)
    mine = lambda: sorted(map(tuple, spark.read.parquet(out).select("symbol", "Date", "ret", "ma_5").collect()), key=repr)
    assert mine() == full()

    since = dt.date(2018, 6, 1)
    fixed = spark.createDataFrame([(s, d, v * 2 if s != "b" and d >= since else v) for s, d, v in rows], df.schema)
    fixed.withColumn("bucket_year", F.year("Date")).write.mode("overwrite").partitionBy("symbol", "bucket_year").parquet(table)
    want = full()
    changed = spark.createDataFrame([("a", since), ("few", since)], "symbol string, first_changed date")
    need = {(r.symbol, r.bucket_year) for r in ingest.needed_partitions(spark.read.parquet(table), changed, 5).collect()}
    assert need == {("a", y) for y in range(2017, 2021)} | {("few", y) for y in range(2015, 2021)}
    # what is not needed can't be read: the files of the other series are no Parquet, nor is the data of earlier years
    for f in glob.glob(f"{table}/symbol=b/*/*.parquet"):
        with open(f, "r+b") as g:
            g.write(b"none" * 3)
            g.seek(-8, 2)
            g.write(b"\xff" * 8)
    for f in glob.glob(f"{table}/symbol=a/bucket_year=201[56]/*.parquet"):
        with open(f, "r+b") as g:
            g.seek(4)
            g.write(b"\xff" * 40)
    for f in glob.glob(f"{table}/*/*/.*.crc"):
        os.remove(f)
    schema_of = f"{table}/symbol=a/bucket_year=2018"
    assert spark.read.parquet(schema_of).count() == 20
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/*/*/*.parquet")}
    original = spark.read.schema("Close double, Date date, symbol string, bucket_year int")
    ingest.recompute_partitions(_Reader(spark, original, table), table, out, changed, feats, 5)
    assert mine() == want
    same = {p for p, t in before.items() if os.path.exists(p) and os.path.getmtime(p) == t}
    touched = {p.split("symbol=")[1].rsplit("/", 1)[0] for p in before if p not in same}
    assert touched == {f"{s}/bucket_year={y}" for s in ("a", "few") for y in (2018, 2019, 2020)}


class _Reader:
    """A session whose reader knows the table's schema, so that no footer is read for it."""

    def __init__(self, spark, reader, table):
        self._spark, self._reader, self._table = spark, reader, table
        self.read = self

    def parquet(self, path):
        return self._reader.parquet(path) if path == self._table else self._spark.read.parquet(path)

    def __getattr__(self, name):
        return getattr(self._spark, name)
