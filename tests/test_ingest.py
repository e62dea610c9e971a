"""By-name loading and streaming of ragged files, safe writes, compaction order, and code on workers."""

import datetime as dt
import os
import subprocess
import sys

from marketframe.operators import audit
from marketframe.sources import files
from marketframe.streaming import ingest

VENDOR = "Price,Close,High,Low,Open,Volume\nTicker,X,X,X,X,X\nDate,,,,,\n2024-01-01,1.5,2,1,9,0\n2024-01-02,2.5,3,2,9,\n"
REORDERED = "Date,Open,Close\r\n2024-01-02,7.0,3.5\r\n2024-01-03 00:00:00,7.0,4.5\r\n,,\r\nnot a date,1,2\r\n"
TUPLES = "Date,\"('Close', 'EURUSD=X')\",\"(\"\"Open\"\", \"\"EURUSD=X\"\")\",Close\n2024-01-04,5.5,8,99\n"
D = {i: dt.date(2024, 1, i) for i in range(1, 10)}


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def closes(df):
    return {r.Date: (r.Close, r.Open) for r in df.select("Date", "Close", "Open").collect()}


def test_ragged_layouts_load_by_name(spark, tmp_path):
    put(tmp_path, "data_2024-01-02_from_2024-01-01.csv", VENDOR)
    put(tmp_path, "data_2024-01-03_from_2024-01-02.csv", REORDERED)
    put(tmp_path, "data_2024-01-04_from_2024-01-04.csv", TUPLES)
    put(tmp_path, "note.txt", "no header\n2024-01-09,1,2\n")
    got = closes(files.load_history(spark, str(tmp_path)))
    assert got == {D[1]: (1.5, 9.0), D[2]: (3.5, 7.0), D[3]: (4.5, 7.0), D[4]: (5.5, 8.0)}
    # equal dates in one file: the later row
    put(tmp_path / "x", "data_2024-01-05_from_2024-01-05.csv", "Date,Close\n2024-01-05,1\n2024-01-05,2\n")
    assert closes(files.load_history(spark, str(tmp_path)))[D[5]] == (2.0, None)


def test_header_cells():
    for cell in ("('Close', 'EURUSD=X')", "\"('Close', 'EURUSD=X')\"", "(\"Close\", \"X\")", "\"(\"\"Close\"\", 'X')\"", " Close ", '"Close"'):
        assert files.clean_column_name(cell) == "Close", cell


def test_stream_equals_batch_for_any_arrival(spark, tmp_path):
    src, table, ck = tmp_path / "src", str(tmp_path / "table"), str(tmp_path / "ck")
    arrivals = [("b1", "data_2024-01-03_from_2024-01-02.csv", REORDERED), ("b2", "merged.csv", "Date,Close,Open\n2024-01-01,0,0\n2024-01-08,8,8\n"),
                ("b3", "data_2024-01-02_from_2024-01-01.csv", VENDOR), ("b4", "data_2024-01-04_from_2024-01-04.csv", TUPLES)]
    for folder, name, text in arrivals:
        put(src / folder / "symbol=A", name, text)
        ingest.run_ingest(spark, str(src), table, ck)
        assert closes(spark.read.parquet(table)) == closes(files.load_history(spark, str(src)))
    # the range file that came first has the larger name, so it keeps the date they share
    assert closes(spark.read.parquet(table))[D[2]] == (3.5, 7.0)
    before = sorted(map(tuple, spark.read.parquet(table).select("symbol", "Date", "Close").collect()))
    ingest.run_ingest(spark, str(src), table, ck)  # nothing new
    assert sorted(map(tuple, spark.read.parquet(table).select("symbol", "Date", "Close").collect())) == before


def test_upsert_tells_what_it_changed(spark, tmp_path):
    table = str(tmp_path / "table")

    def batch(name, rows):
        return spark.createDataFrame([(name, i, "A", D[d], c) for i, (d, c) in enumerate(rows)], "_file string, _row int, symbol string, Date date, Close double")

    changed = lambda b, i: sorted(r.Date for r in ingest.upsert_batch(b, i, table).collect())
    first = batch("data_2024-01-02_from_2024-01-01", [(1, 1.0), (2, 2.0)])
    assert changed(first, 0) == [D[1], D[2]] and changed(first, 0) == []
    assert changed(batch("data_2024-01-03_from_2024-01-02", [(2, 5.0), (3, 3.0)]), 1) == [D[2], D[3]]
    assert changed(batch("data_2024-01-01_from_2024-01-01", [(1, 9.0)]), 2) == []


def test_changed_since_sees_nulls_and_deletions(spark):
    def t(rows):
        return spark.createDataFrame(rows, "symbol string, Date date, Close double")

    before = t([("null", D[1], 1.0), ("null", D[2], 2.0), ("gone", D[1], 1.0), ("gone", D[2], 1.0), ("same", D[1], None), ("filled", D[3], None)])
    after = t([("null", D[1], 1.0), ("null", D[2], None), ("gone", D[1], 1.0), ("same", D[1], None), ("filled", D[3], 1.0), ("new", D[4], None)])
    got = {r.symbol: r.first_changed for r in ingest.changed_since(before, after).collect()}
    assert got == {"null": D[2], "gone": D[2], "filled": D[3], "new": D[4]}


def test_superseded_is_containment(spark):
    rows = [("a", 1, 9), ("b", 2, 3), ("c", 1, 9), ("d", 5, 10), ("e", 9, 10), ("f", 10, 12), ("g", None, None)]
    cat = spark.createDataFrame(rows, "path string, start int, end int")
    want = {p for p, s, e in rows if s and any(q != p and t and t <= s and e <= u and ((t, u) != (s, e) or p < q) for q, t, u in rows)}
    assert {r.path for r in files.superseded(cat).collect()} == want == {"a", "b", "e"}
    keyed = spark.createDataFrame([("x", *rows[0]), ("y", *rows[1])], "symbol string, path string, start int, end int")
    assert files.superseded(keyed, by=["symbol"]).count() == 0


def test_failed_write_keeps_the_history(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "history")
    good = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    files.write_merged(good, path)
    try:
        files.write_merged(good.withColumn("close", F.raise_error(F.lit("broken")).cast("double")), path)
        raise AssertionError
    except Exception as e:
        assert "broken" in str(e)
    assert spark.read.parquet(path).count() == 1
    files.write_merged(spark.read.parquet(path).union(good.withColumn("symbol", F.lit("B")).select("close", "symbol")), path)
    assert sorted(r.symbol for r in spark.read.parquet(path).collect()) == ["A", "B"]
    assert os.listdir(tmp_path) == ["history"]


def test_file_profile_counts_unique_rows(spark):
    df = spark.createDataFrame([("f1", "A", 1), ("f1", "A", 2), ("f2", "A", 2), ("f2", "A", 3)], "_file string, symbol string, ts int")
    got = {r._file: (r.rows, r.unique_rows, r.first_date, r.last_date) for r in audit.file_profile(df).collect()}
    assert got == {"f1": (2, 1, 1, 2), "f2": (2, 2, 2, 3)}


def test_aliases_beyond_the_named_ones(spark):
    from marketframe.operators import runs as rg

    aliases = spark.createDataFrame([("m1", "champion", 1), ("m4", "rank_4", 1), ("m5", "rank_5", 1)], "name string, alias string, version bigint")
    versions = spark.createDataFrame([(f"m{i}", 1, f"r{i}") for i in (1, 4, 5)], "name string, version bigint, run_id string")
    assert sorted((r.alias_rank, r.run_id) for r in rg.top_by_alias(aliases, versions, n=4).collect()) == [(0, "r1"), (3, "r4")]


def test_python_paths_run_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from marketframe.session import local_session
spark = local_session(2, 2)
import __spark_entry__ as e
print("ROWS", e.queries()["ml02_ridge_bars" if "ml02_ridge_bars" in e.queries() else "ml04_ridge_grid_bars"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_repointing_in_one_pass_equals_the_three_steps(spark):
    from pyspark.sql import functions as F

    from marketframe.operators import runs as rg

    versions = spark.createDataFrame([("x", n, v, f"{n}{v}") for n, k in (("m1", 3), ("m2", 1), ("m3", 2)) for v in range(1, k + 1)] + [("y", "m1", 1, "r")], "g string, name string, version bigint, run_id string")
    aliases = spark.createDataFrame([("x", "m1", "champion", 2), ("x", "m2", "champion", 1), ("x", "m1", "challenger", 3), ("x", "m3", "candidate", 1), ("x", "m2", "rank_4", 1), ("x", "gone", "rank_5", 4), ("y", "m1", "champion", 1), ("y", "lost", "challenger", 7)], "g string, name string, alias string, version bigint")
    for n in (1, 3, 4):
        picked = rg.top_by_alias(aliases, versions, ["g"], n).select("g", "name", "alias")
        new = rg.register_next(versions, picked, picked.select("g", "name").distinct().withColumn("run_id", F.lit("new")), ["g"])
        want = rg.repoint_aliases(aliases, new, ["g"]).select("g", "name", "alias", "version")
        got = rg.repoint_retrained(aliases, versions, ["g"], n)
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
