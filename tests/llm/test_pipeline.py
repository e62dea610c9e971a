"""The pipeline's stages, each on what its predecessor kept, against brute force on the small table."""

from collections import Counter

import pytest

import corpus_pipeline
from marketframe.llm import langid
from marketframe.llm.components import written
from tests.conftest import SMALL
from tests.llm.data import WORD
from tests.llm.test_dedup import groups
from tests.llm.test_operators import contamination, water

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [[tuple(r) for r in docs.select(COLUMNS).collect()]]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        out.append([tuple(r) for r in docs.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out, docs.columns


def test_order_and_oracle():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontaminate", "mix"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_what_the_parse_knows(spark, stages):
    before, after = stages[0][0], stages[0][1]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    parser = langid.Parser(langid.sample(docs.where(~langid.held_out())))
    want = []
    for r in before:
        langs, _, rate = parser.predict([r[1] or ""])
        if langs[0] != "und" and (rate[0] <= 0.5 or len(r[1]) < 20):
            want.append(r)
    assert sorted(after) == sorted(want) and len(after) > 0.95 * len(before)


def test_line_stage(stages):
    before, after = stages[0][1], stages[0][2]
    pages, on = Counter(r[3] for r in before), Counter((r[3], x) for r in before for x in {x.strip(" \t\r") for x in r[1].split("\n")} if x)
    bad = {k for k, n in on.items() if n >= 5 and n > 0.05 * pages[k[0]]}
    want = []
    for i, t, lang, s, n in before:
        kept = "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in bad)
        want.append((i, kept, lang, s, len(kept) if kept != t else n))
    assert sorted(after) == sorted(want)


def test_jaccard_stage_keeps_one_of_each_group(stages):
    before, after = stages[0][2], stages[0][3]
    rows = [(r[0], r[1], r[3]) for r in before]
    sets, group = groups(rows, 5, 80, 100)
    least = {}
    for r, s, g in zip(before, sets, group, strict=True):
        key = g if s else ("empty", r[0])
        least[key] = min(least.get(key, r), r)
    assert sorted(after) == sorted(least.values()) and len(after) < len(before)


def test_benchmark_stage_drops_contaminated_documents(spark, stages):
    before, after = stages[0][3], stages[0][4]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {i for i, n, hit, _ in contamination([(r[0], r[1], r[3]) for r in before], items) if hit and 20 * hit >= n}
    assert sorted(after) == sorted(r for r in before if r[0] not in bad) and bad


def test_mix_stage(stages):
    (before, after), columns = stages[0][4:6], stages[1]
    size = Counter()
    for r in before:
        size[r[3]] += len(WORD.findall(r[1]))
    want, taken = water(size, (5, 2, 1), 1.5, 2), Counter()
    largest = Counter()
    for r in after:
        row = dict(zip(columns, r, strict=True))
        assert r[:5] in before and row["taken"] in (row["size"], 2 * row["size"]) and row["size"] == len(WORD.findall(row["text"]))
        taken[row["source"]] += row["taken"]
    for r in before:
        largest[r[3]] = max(largest[r[3]], len(WORD.findall(r[1])))
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in size)


def test_run_gives_the_last_stage(spark, stages):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == sorted(stages[0][5])
