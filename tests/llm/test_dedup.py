"""Line dedup, substring dedup and the n-gram Jaccard join against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketframe.llm.components import components
from marketframe.llm.jaccard import _again, jaccard_groups, keep_one, may_link
from marketframe.llm.lines import line_dedup
from marketframe.llm.substrings import repeated_spans, substring_dedup
from tests.llm.data import WORD, documents, folded, frame


def removed(rows, length):
    """(id, words, kept words) of each row."""
    texts = [WORD.findall(t or "") for _, t, _ in rows]
    seen = Counter(tuple(w[j : j + length]) for w in texts for j in range(len(w) - length + 1))
    for (i, _, _), w in zip(rows, texts, strict=True):
        gone = {j + k for j in range(len(w) - length + 1) if seen[tuple(w[j : j + length])] > 1 for k in range(length)}
        yield i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)


@pytest.mark.parametrize("length", [35, 5])
def test_substring_dedup(spark, length):
    got = sorted(map(tuple, substring_dedup(frame(spark), length=length).collect()), key=repr)
    assert got == sorted(removed(documents(), length), key=repr)


def test_texts_that_share_a_key_are_not_lost(spark):
    short = lambda text: F.xxhash64(text) % 5
    got, want = (sorted(map(tuple, substring_dedup(frame(spark), **how).collect()), key=repr) for how in ({"key": short}, {}))
    assert got == want


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(frame(spark, [])).count() == 0
    assert substring_dedup(frame(spark, [(1, None, None)])).collect()[0][1:] == (0, 0, "")


def test_substring_dedup_in_small_shards_and_batches(spark, monkeypatch):
    """Shards of few passages, and anchors over many batches."""
    from marketframe.llm import substrings

    monkeypatch.setattr(substrings, "SHARD", 2)  # closures carry it to the workers
    groups = substrings._groups
    monkeypatch.setattr(substrings, "_groups", lambda batches, *_: groups(batches, 5))
    shared = [" ".join(f"p{j}" for j in range(90)), " ".join(f"q{j}" for j in range(40)) + " end"]
    rows = [(i, f"{'l' * (i % 7)}{i} {shared[0]} r{i} " + "a b " * (i % 50) + (shared[1] if i % 3 else shared[1].replace("q7", f"q7x{i % 2}")), "a") for i in range(150)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, substring_dedup(frame(spark, rows, 12)).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(removed(rows, 35), key=repr)


def test_spans_of_a_shard_against_brute_force():
    rng = np.random.default_rng(4)
    for length in (2, 3, 5):
        shard = [rng.integers(1, 4, int(n)).astype(np.uint64) for n in rng.integers(length, 14, 12)]
        shard = list({p.tobytes(): p for p in shard}.values())
        times = rng.integers(1, 3, len(shard)).tolist()
        seen = Counter()
        for p, n in zip(shard, times, strict=True):
            seen.update({tuple(p[j : j + length].tolist()): 0 for j in range(len(p))})
            for j in range(len(p) - length + 1):
                seen[tuple(p[j : j + length].tolist())] += n
        for p, spans in zip(shard, repeated_spans(shard, times, length), strict=True):
            windows = {j for j in range(len(p) - length + 1) if seen[tuple(p[j : j + length].tolist())] > 1}
            assert {j for a, b in spans for j in range(a, b - length + 1)} == windows


def sets(rows, n):
    for _, t, _ in rows:
        w = WORD.findall(folded(t))
        yield {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def groups(rows, n, num, den):
    """Index of each row's group by all pairs."""
    s = list(sets(rows, n))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            both = len(s[a] & s[b])
            if s[a] and s[b] and den * both >= num * (len(s[a]) + len(s[b]) - both):
                root[find(a)] = find(b)
    return s, [find(x) for x in range(len(s))]


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_jaccard_groups(spark, n, num, den):
    rows = documents()
    s, group = groups(rows, n, num, den)
    want = []
    for i, (row, g) in enumerate(zip(rows, group, strict=True)):
        ids = [r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None]
        want.append((row[0], len(s[i]), row[0] if not s[i] else min(ids, default=None)))
    got = list(map(tuple, jaccard_groups(frame(spark), n=n, threshold=(num, den)).collect()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_keep_one_keeps_one_of_each_group(spark):
    rows = documents()
    s, group = groups(rows, 5, 80, 100)
    docs = frame(spark)
    got = keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text, r.source) for r in got.collect()]
    of = {r: g for r, g in zip(rows, group, strict=True)}
    words = [r for r in kept if WORD.search(r[1] or "")]
    assert sorted(of[r] for r in words) == sorted({g for g, x in zip(group, s, strict=True) if x})
    assert len(kept) - len(words) == sum(not x for x in s)
    assert (3, rows[0][1], "a") in kept  # the smallest id of the copies
    assert keep_one(frame(spark, [])).count() == 0 and jaccard_groups(frame(spark, [])).count() == 0


def test_a_marked_post_still_marks_its_partners():
    """A small group of one n-gram: lead, a, b, c. The pair a, b passes the filters, and so does a, c, but not b, c."""
    sizes = [95, 100, 96, 108]
    hists = [np.array(h, np.uint8) for h in ([19, 38, 38, 0, 0, 0, 0, 0], [24, 38, 38, 0, 0, 0, 0, 0], [19, 38, 38, 1, 0, 0, 0, 0], [24, 38, 38, 0, 8, 0, 0, 0])]
    hist = [int.from_bytes(h.tobytes(), "little", signed=True) for h in hists]
    t = pa.table({"token": pa.array([7] * 4, pa.int64()), "size": pa.array(sizes, pa.int32()), "pos": pa.array([0] * 4, pa.int32()), "hist": pa.array(hist, pa.int64())})
    links = lambda i, j: bool(may_link(*(np.array([x]) for k in (i, j) for x in (sizes[k], 0, hist[k])), 90, 100)[0])
    assert links(1, 2) and not links(2, 3) and links(1, 3) and not links(0, 3)
    assert _again(t, 90, 100).tolist() == [False, True, True, True]


def four_texts():
    """Lead, a, b and c as sets of single words, in order of size: 20 rare ones that all four have, the rest frequent. c is like a only."""
    rare, often, new, more = [f"r{i}" for i in range(20)], [f"f{i}" for i in range(80)], [f"b{i}" for i in range(4)], [f"c{i}" for i in range(11)]
    texts = [rare + often[5:], rare + often, rare + often[:70] + often[73:] + new, rare + often + more]
    # the others make all but ``rare`` frequent; none is like another, nor like the four
    others = [[*often, *new, *more, *(f"own{k}x{i}" for i in range(60))] for k in range(30)]
    return [(i, " ".join(t), "a") for i, t in enumerate(texts)] + [(100 + k, " ".join(t), "a") for k, t in enumerate(others)]


def test_links_in_a_small_group_that_the_lead_has_no_part_in(spark):
    rows = four_texts()
    s, group = groups(rows, 1, 90, 100)
    assert 100 * len(s[1] & s[3]) >= 90 * len(s[1] | s[3]) and all(100 * len(s[x] & s[3]) < 90 * len(s[x] | s[3]) for x in (0, 2))
    got = {r.doc_id: r.component_id for r in jaccard_groups(frame(spark, rows), n=1, threshold=(90, 100)).collect()}
    assert got == {r[0]: min(q[0] for q, h in zip(rows, group, strict=True) if h == g) for r, g in zip(rows, group, strict=True)}
    assert [got[i] for i in range(4)] == [0, 0, 0, 0]


def test_components_of_a_chain_and_a_star(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("500", str(600 + i)) for i in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x string, y string")).collect()}
    assert {v for k, v in got.items() if k < "500"} == {"000"} and {v for k, v in got.items() if k >= "500"} == {"500"} and len(got) == 92


def test_line_dedup(spark):
    rows = documents()
    docs = frame(spark)
    got = line_dedup(docs, max_ratio=0.3, min_pages=3)
    assert set(got.columns) == set(docs.columns) | {"n_lines", "n_removed"}
    trim = lambda x: x.strip(" \t\r")
    pages, on = Counter(s for _, _, s in rows), Counter((s, x) for _, t, s in rows if t is not None for x in {trim(x) for x in t.split("\n")} if x)
    bad = {(s, x) for (s, x), n in on.items() if n >= 3 and n > 0.3 * pages[s]}
    want = []
    for i, t, s in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (s, trim(x)) not in bad]
        want.append((i, s, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    assert ("b", "Subscribe to our page") in bad
    assert sorted([tuple(r) for r in got.select("doc_id", "source", "n_lines", "n_removed", "text").collect()], key=repr) == sorted(want, key=repr)
    assert [r.row for r in got.take(1)] == ["own row"]
    assert line_dedup(frame(spark, [])).count() == 0


def test_line_dedup_leaves_lines_at_the_ratio(spark):
    rows = [(i, "same\nline" if i < 5 else f"l{i}", "h") for i in range(100)]
    assert line_dedup(frame(spark, rows)).where("n_removed > 0").count() == 0
    assert line_dedup(frame(spark, rows[:99])).where("n_removed = 2").count() == 5


def test_digest_is_that_of_the_kept_words(spark):
    from marketframe.llm.queries import QUERIES
    from tests.conftest import SMALL

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in removed(rows, 35)}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_substring_dedup"](spark, SMALL).collect()} == want


def test_jaccard_query_on_the_small_table(spark):
    from marketframe.llm.queries import QUERIES
    from tests.conftest import SMALL

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    s, group = groups(rows, 3, 90, 100)
    least = {g: min(r[0] for r, h in zip(rows, group, strict=True) if h == g) for g in set(group)}
    want = {r[0]: (len(x), least[g] if x else r[0]) for r, x, g in zip(rows, s, group, strict=True)}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_ngram_jaccard_join"](spark, SMALL).collect()} == want
