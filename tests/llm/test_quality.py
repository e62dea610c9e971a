"""The rule ensemble: rules against the trees, the compiled column against plain evaluation, accuracy on documents held out."""

import math
import zlib

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from marketframe.llm import quality
from marketframe.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.data import documents, frame, prose

MIDDLE = "/root/testdata/sf0.01"


def holds(rule, values):
    return all(values[i] <= x if most else values[i] > x for i, most, x in rule)


def logistic(model, values):
    return 1 / (1 + math.exp(-model.intercept - sum(w for w, r in model.rules if holds(r, values))))


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    return quality.labelled(docs, labels).persist()


def test_paths_say_what_the_trees_say(learned):
    rows = learned.coalesce(1).sortWithinPartitions("id").select("label", array_to_vector(F.array(*quality.STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=5, maxDepth=3, seed=3).fit(rows)
    points = [r.features for r in rows.limit(200).collect()]
    for tree in forest.trees:
        rules = list(quality.paths(tree.toDebugString))
        assert len(set(rules)) == tree.numNodes - 1
        ways = {}  # the rules that hold are the way to one leaf
        for p in points:
            way = tuple(r for r in rules if holds(r, p.toArray().tolist()))
            assert 1 <= len(way) <= tree.depth
            ways.setdefault(way, set()).add(tree.predictLeaf(p))
        assert all(len(v) == 1 for v in ways.values()) and len({min(v) for v in ways.values()}) == len(ways)


def test_compiled_column_is_the_rules_sum(spark, learned):
    model = quality.fit(learned)
    assert 3 <= len(model.rules) <= 120 and all(w for w, _ in model.rules)
    docs = frame(spark)
    got = quality.classify(docs, model)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(documents())
    values = {r["row"]["text"]: [r[c] for c in quality.STATISTICS] for r in quality.statistics(docs).collect()}
    for r in got.collect():
        assert r.score == pytest.approx(logistic(model, values[r.text]), abs=1e-12) and 0 <= r.score <= 1
    assert len({r.score for r in got.collect() if not r.text}) == 1  # null and empty


def test_statistics_by_hand(spark):
    rows = [(1, "Ab ab  ab\nC!! 12\nC!! 12\n$$$ x.", "s")]
    r = quality.statistics(frame(spark, rows)).first().asDict()
    want = {"word_length": 9 / 9, "capital_share": 3 / 9, "symbols_a_word": 3 / 9, "marks_a_word": 1 / 9, "calls_a_word": 4 / 9, "doubled_share": 1 / 9, "word_kinds": 6 / 9, "line_kinds": 3 / 4, "ended_lines": 1 / 4}
    assert {k: r[k] for k in want} == pytest.approx(want)
    assert r["length"] == pytest.approx(math.log1p(len(rows[0][1]))) and r["word_count"] == pytest.approx(math.log1p(9)) and r["words_a_line"] == pytest.approx(math.log1p(9 / 4))


def test_long_and_odd_texts(spark):
    odd = [(1, "a " * 300_000, "s"), (2, "y" * 3_000_000, "s"), (3, "!" * 50_000, "s"), (4, "\n" * 50_000, "s"), (5, "\x00퟿" * 9, "s"), (6, None, "s")]
    r = {x["row"]["doc_id"]: x for x in quality.statistics(frame(spark, odd)).collect()}
    assert r[1].word_kinds == pytest.approx(1 / 300_000) and r[2].word_length == 3_000_000 and r[6].length == 0 and r[4].line_kinds == pytest.approx(1 / 50_001)


def test_sample_is_bounded_and_needs_one_opinion(spark):
    docs = frame(spark, [(i, prose(i, 20), "s") for i in range(40)] + [(3, prose(99, 20), "s"), (None, "x", "s")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, 1), (4, 0), (6, 0), (7, None), (None, 1), (8, 5)], "doc_id long, quality int")
    rows = quality.labelled(docs, labels).collect()
    assert sorted(r.id for r in rows) == [i for i in range(40) if i != 4]
    few = quality.labelled(docs.repartition(3), labels.repartition(2), sample=10)
    assert few.count() == 10 and sorted(r.id for r in few.collect()) == sorted(r.id for r in quality.labelled(docs, labels, sample=10).collect())


def test_few_or_one_sided_labels(spark):
    docs = frame(spark)
    for labels, want in (([], 0.5), ([(10, 1), (3, 1), (11, 1)], 3.5 / 4), ([(10, 0)], 0.25)):
        model = quality.fit(quality.labelled(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
        assert not model.rules and {round(r.score, 9) for r in quality.classify(docs, model).collect()} == {want}
    assert quality.classify(frame(spark, []), quality.Model(0.0)).count() == 0


def test_quality_query(spark, tmp_path):
    got = {r.doc_id: r for r in QUERIES["op13_quality_classifier"](spark, MIDDLE).collect()}
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    truth = [(r.quality, got[r.doc_id]) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert sum(q == r.predicted for q, r in truth) >= 0.95 * len(truth)
    good, bad = [r.score for q, r in truth if q], [r.score for q, r in truth if not q]
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) >= 0.97 * len(good) * len(bad)
    # held-out labels, languages and sources are no input
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    turned.repartition(3).write.parquet(f"{tmp_path}/labels.parquet")
    docs.repartition(4).withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "score": F.lit(9)}).write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: r.score for r in QUERIES["op13_quality_classifier"](spark, str(tmp_path)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_quality_query_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES["op13_quality_classifier"](spark, str(tmp_path)).count() == 0
