"""Extraction, decontamination, mixing, neighbours, WARC, personal data and languages."""

import hashlib
import math
import random
import re
from base64 import b32encode

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import ann, decontaminate, extract, langid, mix, pii, warc
from marketframe.llm.queries import QUERIES
from marketframe.session import scratch_dir
from tests.conftest import SMALL
from tests.llm.data import ALNUM, WORD, documents, folded, frame, prose


# ---------------------------------------------------------------- benchmark decontamination
def contamination(rows, items, window=13):
    """(id, n_words, n_hit, items) of each row."""
    at = {}
    for i, t in items:
        w = ALNUM.findall(folded(t))
        m = min(window, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            at.setdefault(tuple(w[j : j + m]), set()).add(i)
    for i, t, _ in rows:
        w, hit, ids = ALNUM.findall(folded(t)), set(), set()
        for m in {len(k) for k in at}:
            for j in range(len(w) - m + 1):
                if (k := tuple(w[j : j + m])) in at:
                    hit |= set(range(j, j + m))
                    ids |= at[k]
        yield i, len(w), len(hit), sorted({str(x) for x in ids if x is not None})


ITEMS = [(1, prose(2, 60)), (22, prose(2, 30)), (3, "One, TWO."), (4, None), (5, ""), (6, "!?"), (None, prose(1, 40)), (7, "again again again"), (7, prose(50, 20)), (8, prose(9, 13)), (9, "x"), (10, " ".join(prose(7, 6000, 3000).split()[500:520]))]


@pytest.mark.parametrize("block_words", [200_000, 40])
def test_decontamination(spark, block_words):
    rows = documents()
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("n_words", F.lit("own"))
    got = decontaminate.verdicts(frame(spark), items, block_words=block_words).collect()
    want = [(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0 and 20 * h >= n) for i, n, h, ids in contamination(rows, ITEMS)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(w[5] for w in want) and any(w[2] and not w[5] for w in want)


def test_items_come_in_bounded_blocks_and_their_tables_go(spark):
    import os

    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    items = spark.createDataFrame([*ITEMS, (11, prose(60, 2500))], "item_id int, text string").repartition(4)
    got = list(decontaminate.blocks(items, "item_id", "text", 13, 40))
    assert len(got) > 50 and all(sum(len(w) for _, w in block) <= 40 * 8 for block in got)
    assert {i for block in got for i, _ in block} == {str(i) if i else None for i, t in ITEMS if ALNUM.findall(folded(t or ""))} | {"11"}
    assert list(decontaminate.blocks(items.limit(0), "item_id", "text", 13, 40)) == []
    assert not [f for f in os.listdir(shared) if f.startswith("marketframe-items-")]


def test_decontaminate_drops_or_cuts(spark):
    items = spark.createDataFrame([(1, prose(2, 60))], "item_id int, text string")
    rows = [(1, "keep, " + prose(2, 60) + "  and this", "a"), (2, prose(5, 30), "a"), (3, None, "a"), (4, prose(6, 900) + "\n" + prose(2, 20) + " end", "a")]
    docs = frame(spark, rows)
    got = decontaminate.decontaminate(docs, items)
    assert got.columns == docs.columns and {r.doc_id: r.text for r in got.collect()} == {i: t for i, t, _ in rows if i != 1}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, drop=False, max_span=15).collect()}
    assert cut == {1: "keep, and this", 2: rows[1][1], 3: None, 4: prose(6, 900) + "\nend"}
    assert decontaminate.verdicts(docs, items.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.verdicts(frame(spark, []), items).count() == 0


def test_decontamination_query(spark):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {i: (n, h, len(ids)) for i, n, h, ids in contamination(rows, items)}
    got = QUERIES["op5_benchmark_decontamination"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == want and sum(r.contaminated for r in got) > 0


# ---------------------------------------------------------------- mixing
def water(sizes, weights, share, repeats):
    """Targets by resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, list(names)
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > repeats * sizes[s]]
        if not full:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in full:
            target[s] = repeats * sizes[s]
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return target


@pytest.mark.parametrize("share", [1.5, 0.4, 2.0])
def test_mix(spark, share):
    rows = documents()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    want = water(size, (5, 2, 1), share, 2)
    docs = frame(spark)
    got = mix.mix(docs, share=share, keep=tuple(docs.columns)).collect()
    assert sorted([(r.doc_id, r.size, r.source) for r in got], key=repr) == sorted([(i, len(WORD.findall(t or "")), s) for i, t, s in rows], key=repr)
    for s in size:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {size[s]} and all(math.isclose(r.target, want[s], rel_tol=1e-12) for r in own)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own) / 2 + 1
    assert all(r.row.text == t for r in got for i, t, _ in rows if i is not None and i < 400 and r.doc_id == i)
    again = mix.mix(docs.repartition(3), share=share).collect()
    assert sorted([(r.doc_id, r.size, r.taken) for r in again], key=repr) == sorted([(r.doc_id, r.size, r.taken) for r in got], key=repr)


def test_mix_of_nothing(spark):
    assert mix.mix(frame(spark, [])).count() == 0
    assert [r.taken for r in mix.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]
    assert [r.taken for r in mix.mix(frame(spark, [(1, "a b c", "s")])).collect()] == [6]


def test_mix_uses_no_python(spark):
    plan = mix.mix(frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("ExternalRDDScan", ""))


# ---------------------------------------------------------------- nearest neighbours
def nearest(rows, k):
    """By brute force, row by row."""
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in ok:
        if q % 20 == 0:
            s = sorted(((-(v * ok[q]).sum(), i) for i, v in ok.items() if i != q))[:k]
            out[q] = [(n, i, -x) for n, (x, i) in enumerate(s, 1)]
    return out


def vectors():
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, [float(x) for x in range(1, 9)]) for i in range(130)]  # one vector many times
    return rows + [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] + [1.0] * 7), (2080, [float("inf")] * 8), (2100, [1.0]), (2120, []), (None, [1.0] * 8), (5, rows[5][1]), (20, rows[20][1])]


def test_neighbours(spark):
    df = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<double>").withColumns({c: F.lit("own") for c in ("id", "v", "q", "block", "part", "score")})
    is_query = F.pmod(F.col("id"), F.lit(20)) == 0
    want = nearest(vectors(), 7)
    for options in ({}, {"block_rows": 64, "query_rows": 5}):
        got = {}
        for r in ann.neighbours(df, is_query, k=7, **options).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert got == want
    assert ann.neighbours(df.limit(0), is_query).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 3.0])], "vec_id bigint, embedding array<double>")
    assert [(r.vec_id, r.score) for r in ann.neighbours(few, is_query).orderBy("rank").collect()] == [(1, 1.0), (2, 0.5)]


def test_neighbours_recall(spark):
    path = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{path}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy()
    got = QUERIES["op7_nearest_neighbours"](spark, path).toPandas()
    found, hits = {q: set(v.vec_id) for q, v in got.groupby("query_id")}, []
    for q in ids[ids % 20 == 0]:
        s = (x * x[ids == q][0]).sum(1)
        s[ids == q] = -9
        hits.append(len(found[q] & set(ids[np.argsort(-s, kind="stable")[:20]])) / 20)
    assert np.mean(hits) >= 0.97 and len(got) == 20 * len(hits)


def test_footrule_is_that_of_whole_orders():
    r = np.random.default_rng(1)
    order = np.array([r.permutation(12)[:5] for _ in range(30)])
    files, q = ann.InvertedFiles(order, 12), order[3]
    place = lambda o: {p: i for i, p in enumerate(o.tolist())}
    want = [sum(abs(place(o).get(p, 5) - place(q).get(p, 5)) for p in range(12)) for o in order]
    assert files.footrule(q).tolist() == want and want[3] == 0


# ---------------------------------------------------------------- WARC
PAGES = [(1, "http://www.Example.com/b?x=1#top", "<p>one</p>"), (9, "https://example.com/a", "<p>one</p>"), (4, None, "<p>one</p>"), (5, "http://z.org", None), (6, "http://z.org/", ""), (7, "http://z.org/é", "é\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://n.org/", "<p>one</p>"), (None, "http://n.org/2", "only"), (8, "u\r\nWARC-Type: bad", "x" * 3_000_000), (9, "https://example.com/a", "<p>one</p>"), (2, "http://z.org/", "y")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumns({c: F.lit("own") for c in ("id", "n", "digest", "first", "record", "payload")})
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages.repartition(3), path, records_per_file=2)
    got = warc.merge_index(warc.read_archives(spark, path)).collect()
    text = [(i, u, h or "") for i, u, h in PAGES]
    top = {}
    for i, _, h in text:
        top[h] = max([x for x in (top.get(h), i) if x is not None], default=None)
    want = []
    for i, _, h in text:
        revisit = top[h] is not None and i != top[h]
        want.append((i, len(h.encode()), b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if revisit else "response", top[h] if revisit else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == sorted(want, key=repr)
    order = [(r.url_key, r.ts) for r in got]
    assert order == sorted(order)
    assert {r.page_id: r.url_key for r in got if r.page_id in (1, 9, 4, 5)} == {1: "com,example)/b?x=1", 9: "com,example)/a", 4: "", 5: "org,z)/"}
    empty = scratch_dir(spark, "warc-test")
    warc.write_archives(pages.limit(0), empty)
    assert warc.merge_index(warc.read_archives(spark, empty)).count() == 0


def test_warc_of_any_ids_and_files_of_few_bytes(spark):
    ids = [2**62, -(2**62), 10**15, 10**12, 2**63 - 1, -(2**63), None, 0, -1, 5]
    rows = [(i, "http://a.com/x", f"<p>{i}</p>" * (1 + k % 3) * 400) for k, i in enumerate(ids)] + [(7, "http://a.com/x", f"<p>{2**62}</p>" * 400)]
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2), path, bytes_per_file=20_000)
    read = warc.read_archives(spark, path).collect()
    assert len({r.archive for r in read}) >= 4 and all(len(r.ts) == 14 for r in read)
    got = warc.merge_index(warc.read_archives(spark, path).repartition(3)).collect()
    assert sorted((r.page_id for r in got), key=repr) == sorted([*ids, 7], key=repr)
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {7: 2**62}
    order = [(r.url_key, r.ts, r.page_id is not None, r.page_id or 0) for r in sorted(got, key=lambda r: r.ts)]
    assert order == sorted(order)


def test_small_payloads_are_all_responses(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"), path, min_bytes=11)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}


def test_damaged_archives_are_found(spark):
    import gzip

    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, _, b in warc.records(memoryview(gzip.compress(good) + gzip.compress(good)))] == [b"abcd", b"abcd"]
    for bad in (good[:-3], good.replace(b": 4", b": 3"), good + b"WARC/1.1\r\n", b"HTTP/1.1 200\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(memoryview(gzip.compress(bad))))


def test_loser_tree():
    r = random.Random(5)
    for k in (0, 1, 2, 3, 7, 8):
        runs = [sorted(r.randrange(50) for _ in range(r.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


# ---------------------------------------------------------------- personal data
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, found):
    d = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) < 256 for p in found.split("."))
    return kind == "email" or kind == "phone" and 8 <= len(d) <= 15 or kind == "card" and 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def by_pattern(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in BASE.items()}


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(6)
    for _ in range(30_000):
        text = "".join(r.choice(r.choice(["0123456789", ".@+- ()", "ab%é", "4111 1111", "0"])) for _ in range(r.randrange(60)))
        found = pii.spans(text)
        assert {k: found[k] for k in BASE} == by_pattern(text), text


def test_added_spans_and_masking():
    text = "See https://a.example/x?y=1, token = \"abcdefgh12\" IBAN GB82 WEST 1234 5698 7654 32 or account no. 12345678; accounting 99999999"
    found = pii.spans(text)
    assert [text[a:b] for k in pii.ADDED for a, b in found[k]] == ["https://a.example/x?y=1", "GB82 WEST 1234 5698 7654 32", "12345678", "abcdefgh12"]
    assert pii.spans("iban GB83 WEST 1234 5698 7654 32")["account"] == []
    assert pii.masked("a@b.co é +1 (555) 555-0100") == "[EMAIL] é [PHONE]"


def test_pii_of_a_table(spark):
    rows = [(1, "é x a.b@c.de, 1.2.3.4 and 1.2.3.400, +1 (555) 555-0100, 4111 1111 1111 1111", "a"), (2, None, "a"), (3, "", "a"), (1, "a@b.c", "a"), (4, "a@b.c " * 20_000, "a")]
    got = {(r.doc_id, r.n_email): r.pii_ for r in pii.find(frame(spark, rows)).select("doc_id", F.col("pii.n_email").alias("n_email"), F.col("pii").alias("pii_")).collect()}
    assert set(got) == {(1, 1), (2, 0), (3, 0), (4, 20_000)}
    listed = ",".join(f"{k}:{a}:{b}" for k, v in by_pattern(rows[0][1]).items() for a, b in v)
    one = [r.pii for r in pii.find(frame(spark, rows[:1])).collect()][0]
    assert one.spans == listed and one.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and tuple(one)[:4] == (1, 1, 1, 1)
    assert got[2, 0].base_sha256 == hashlib.sha256(b"").hexdigest() and pii.find(frame(spark, [])).count() == 0
    assert pii.redact(frame(spark, rows[:2])).where("text is null").count() == 1


# ---------------------------------------------------------------- languages
def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    got = QUERIES["op10_language_id"](spark, path).join(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    import zlib

    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    out = got[got.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.98 and got.score.between(0, 1).all() and len(out) > 2000


def test_predictions_of_awkward_texts(spark):
    texts = {"aa": ["banana banan nab"] * 3, "bb": ["xylyx lyxy xyl"]}
    rows = [(1, "BANANA 123", "a"), (2, "lyxyxyl!", "a"), (3, None, "a"), (4, "", "a"), (5, "12 !? 34", "a"), (6, "Привет мир", "a"), (7, "nab " * 40_000, "a"), (None, "xyl", "a"), (1, "BANANA 123", "a")]
    got = langid.predict(frame(spark, rows), texts).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0))] == ["aa", "aa", "bb", "und", "und", "und", "bb", "aa", "bb"]
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and all(r.row == "own row" for r in got)
    assert {r.lang_pred for r in langid.predict(frame(spark, rows), {}).collect()} == {"und"}
    assert langid.predict(frame(spark, []), texts).count() == 0
    assert {r.doc_id for r in langid.keep_known(frame(spark, [*rows, (9, "qwrtpsdfg" * 9, "a")]), texts).collect()} == {1, 2, 6, 7, None}


def test_phrases_by_a_plain_parse():
    r = random.Random(8)
    texts = {"a": ["".join(r.choice("ab c") for _ in range(200))], "b": ["".join(r.choice("abc ") for _ in range(90)), "zz top"]}
    parser = langid.Parser(texts)
    for n in (1, 5, 40, langid.BLOCK + 7, 3 * langid.BLOCK):
        text = "".join(r.choice("abcz !") for _ in range(n))
        clean = lambda t: re.sub("[^a-z]+", " ", t)
        s, count, _ = langid._symbols([text], parser.alphabet)
        want = []
        for lang in parser.langs:
            k = 0
            for b in range(0, len(clean(text)), langid.BLOCK):
                x = clean(text)[b : b + langid.BLOCK]
                while x:
                    k += 1
                    m = next((m for m in range(len(x), 0, -1) if any(x[:m] in clean(t) for t in texts[lang])), 1)
                    x = x[m:]
            want.append(k)
        assert parser.phrases(s, count)[0].tolist() == want


def scripts():
    """Labelled texts and new ones of two languages with 800 letters each, beside one of Latin letters."""
    r = random.Random(11)
    words = {"zh": ["".join(chr(0x4E00 + r.randrange(800)) for _ in range(2)) for _ in range(1500)], "ko": ["".join(chr(0xAC00 + r.randrange(800)) for _ in range(2)) for _ in range(1500)], "en": prose(3, 900).split()}
    make = lambda lang, n: ("" if lang == "zh" else " ").join(r.choice(words[lang]) for _ in range(n))
    return {lang: [make(lang, 150) for _ in range(12)] for lang in words}, [(lang, make(lang, 60)) for lang in words for _ in range(8)]


def test_languages_of_many_letters(spark):
    texts, new = scripts()
    parser = langid.Parser(texts)
    assert len(parser.alphabet) > 1400
    got, score, _ = parser.predict([t for _, t in new])
    assert got == [lang for lang, _ in new] and score.min() > 0.05
    rows = [(i, t, "a") for i, (_, t) in enumerate(new)] + [(99, "".join(random.Random(3).choice("бвгджзклмн") for _ in range(90)), "a")]
    assert {r.doc_id for r in langid.keep_known(frame(spark, rows), texts).collect()} >= set(range(len(new)))


def test_sample_is_bounded_and_leaves_out_held_out(spark):
    rows = [(i, f"text {i} " + "ab" * (i % 5), "a") for i in range(500)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.lit("x")))
    got = langid.sample(docs.where(~langid.held_out()), sample_docs=20, sample_chars=6)
    assert list(got) == ["x"] and 0 < len(got["x"]) <= 20 and all(len(t) <= 6 for t in got["x"])


# ---------------------------------------------------------------- extraction
PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a="<p>no</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice"><p>We use cookies.</div><main><article><header><h1>A &amp; B</h1><span>by x</span></header>
<p>First   para&nbsp;graph, <b>bold<br>text</b>.<p>Second &lt;one&gt; <a href=y>link</a>.<ul><li>Item one<li>Item two</ul><aside>Side</aside>
<script>no()</script><!-- no <p>no</p> --><div class="comments"><p>Reader says no.</p></div><form><p>Name <input></p></form></article></main>
<div id="sidebar">No</div><footer>&copy; No</footer></body></html>"""


def test_extraction():
    assert extract.main_text(PAGE) == "A & B\n\nFirst para graph, bold text.\n\nSecond <one> link.\n\nItem one\n\nItem two"
    for cue in ("comments", "userComments", "comment-list", "commentsection", "ad-slot", "adslot top", "cookie_banner", "site-footer", "newsletterBox", "related-posts", "mod-notice"):
        page = f"<body><div class='{cue}'><p>Long words of a reader, and so on.</p></div><article class='post'><h2>T</h2><p>One, two.</p><div id='{cue}'><p>No.</p></div></article></body>"
        assert extract.main_text(page) == "T\n\nOne, two.", cue
    for kept in ("content", "commentary", "shareholders", "address", "navy-facts", "article-body"):
        assert extract.main_text(f"<article><div class='{kept}'><p>One, two.</p></div></article>") == "One, two.", kept
    soup = "<div id=top><a href=1>Home</a> <a href=2>News</a></div><div><h1>T</h1><div><p>" + "Long words, and so on. " * 9 + "</p><p>Be.</p></div></div><div><a href=3>More</a></div>"
    assert extract.main_text(soup) == "T\n\n" + ("Long words, and so on. " * 9).strip() + "\n\nBe."
    for page in (None, "", "   ", "<html>", "<nav>Menu</nav>", "<!-- x", "<script>a", "<p", "<a href='x>y"):
        assert extract.main_text(page) == ""
    assert extract.main_text("plain &eacute; text") == "plain é text"


def test_cue_words_in_a_name_do_not_lose_the_article():
    text = "<p>" + "Long words, and so on. " * 9 + "</p><p>Be.</p>"
    want = "T\n\n" + ("Long words, and so on. " * 9).strip() + "\n\nBe."
    for name in ("content has-sidebar", "layout no-ads", "post related-enabled", "social-science", "post comments-open"):
        for page in ("<div class='{}'><article><h1>T</h1>{}</article></div>", "<article><div id='{}'><h1>T</h1>{}</div></article>", "<body><p>x</p><div class='{}'><article><h1>T</h1>{}</article></div>", "<div class='{}'><div><h1>T</h1>{}</div></div>"):
            assert extract.main_text(page.format(name, text)) == want, (name, page)
        assert extract.main_text(f"<div class='{name}'><article><h1>T</h1>{text}<div class='related-posts'><p>No.</p></div></article></div>") == want, name
    for cue in ("comment-list", "sidebar", "user-comments"):  # however long
        assert extract.main_text(f"<div class='{cue}'>{text * 9}</div><div><h1>T</h1>{text}</div>") == want, cue


def test_links_in_an_article_stay():
    assert extract.main_text("<article><h1><a href=x>Title</a></h1><p>One, two.</p><ul><li><a href=1>A</a><li><a href=2>B</a></ul></article>") == "Title\n\nOne, two.\n\nA\n\nB"
    assert extract.main_text("<div><h1><a href=x>Title</a></h1><p>" + "One, two. " * 20 + "</p></div>") == "Title\n\n" + ("One, two. " * 20).strip()


LONG = "<p>" + "Long words, and so on. " * 9 + "</p>"
PLAIN = ("Long words, and so on. " * 9).strip()


def test_no_article_is_lost_to_what_is_around_it():
    want = f"T\n\n{PLAIN}\n\n{PLAIN}"
    for page in (
        "<body><form id=aspnetForm><nav>Menu</nav><article><h1>T</h1>{0}{0}</article></form><footer>(c) us</footer>",
        "<body><form id=aspnetForm><div><h1>T</h1>{0}{0}</div></form>",
        "<div class='social'><article><h1>T</h1>{0}{0}</article></div><div><p>Some words of others, as well.</p></div>",
        "<div class='related'><div><h1>T</h1>{0}{0}</div></div>",
        "<div class='sidebar-layout sidebar'><article><h1>T</h1>{0}{0}</article></div>",
    ):
        assert extract.main_text(page.format(LONG)) == want, page
    lead = f"<div><h1>T</h1><p>A lead, first of all.</p><div>{LONG}{LONG}</div><p>Closing words, at last.</p></div>"
    for page in (lead, f"<body>{lead}", f"<main>{lead}</main>", lead[5:-6]):
        assert extract.main_text(page) == f"T\n\nA lead, first of all.\n\n{PLAIN}\n\n{PLAIN}\n\nClosing words, at last.", page
    assert extract.main_text(f"<article>{LONG}<div class='recommendation'><p>Do so.</p></div></article>") == f"{PLAIN}\n\nDo so."


def test_what_scores_low_goes():
    want = f"T\n\n{PLAIN}\n\n{PLAIN}"
    text = f"<div><h1>T</h1>{LONG}{LONG}</div>"
    for before in ("<ul><li>Home<li>News<li>Sport</ul>", "<div class=top><span>Home</span> <span>News</span></div>", "<div><a href=1>Home</a></div>"):
        for after in ("<p>Copyright 2024.</p>", "<div>Copyright 2024 by us. All rights reserved.</div>", "<div>&copy; us</div>"):
            assert extract.main_text(f"<body>{before}{text}{after}") == want, (before, after)


def test_scores_and_threshold_decide(monkeypatch, spark):
    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    texts = [extract.main_text(p) for p in pages]
    monkeypatch.setattr(extract, "THRESHOLD", 0.0)
    assert all(len(extract.main_text(p)) > len(t) for p, t in zip(pages, texts, strict=True))
    monkeypatch.setattr(extract, "THRESHOLD", math.inf)
    assert not any(extract.main_text(p) for p in pages)


def test_scores_against_a_plain_computation():
    from html.parser import HTMLParser

    class Plain(HTMLParser):  # for pages whose elements are all closed
        def __init__(self):
            super().__init__()
            self.stack, self.found = [], []

        def handle_starttag(self, tag, attrs):
            self.stack.append(tag)

        def handle_endtag(self, tag):
            assert self.stack.pop() == tag

        def handle_data(self, data):
            if data.strip():
                self.found.append((tuple(self.stack), data))

    r = random.Random(3)
    for _ in range(30):
        text = lambda: " ".join(r.choice(["one", "two,", "three.", "fourteen!", "x"]) for _ in range(r.randint(1, 30)))  # noqa: B023, E731
        page = "".join("<div>" + "".join(f"<{t}>{text()}</{t}>" for t in r.choices(["p", "h2", "pre", "blockquote"], k=r.randint(1, 6))) + "</div>" * 1 for _ in range(4))
        page = f"<html><body><section>{page}</section><p>{text()}</p></body></html>"
        plain = Plain()
        plain.feed(page)
        groups = {}
        for path, data in plain.found:
            groups.setdefault(path, []).append(data)
        ratio = {p: (sum(map(len, x)) / len(x), sum(c in ".,!" for t in x for c in t) / len(x)) for p, x in groups.items()}
        want = {}
        for p in groups:
            beside = [q for q in groups if q[:-1] == p[:-1]]
            i = beside.index(p)
            near = [(beside[j], w) for j, w in ((i - 1, 1), (i, 6), (i + 1, 1)) if 0 <= j < len(beside)]
            chars, marks = (math.exp(sum(w * math.log(1 + ratio[q][k]) for q, w in near) / sum(w for _, w in near)) - 1 for k in (0, 1))
            want[p] = math.sqrt(chars * (1 + marks))
        got = extract.parse(page)

        def path(k):
            out = []
            while k:
                k, tag = got.paths[k]
                out.append(tag)
            return tuple(reversed(out))

        assert {path(k[0]): v for k, v in extract.scores(got).items()} == pytest.approx(want)


@pytest.mark.parametrize("make", [lambda n: "<div>" * n + "Text, and so on.", lambda n: "<b><p>Words, so.</p>" * n, lambda n: "<p><b>Words, so." * n, lambda n: "<svg><p>Words, so." * n, lambda n: "<td><li><a>Words, so." * n])
def test_extraction_takes_linear_time(make):
    import time

    def seconds(n):
        page, t = make(n), time.process_time()
        assert extract.main_text(page) is not None
        return time.process_time() - t

    seconds(500)
    assert min(seconds(16_000) for _ in range(2)) < 12 * max(0.02, seconds(4_000))


def test_extraction_of_a_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<article>" + "<p>A b.</p>" * 30_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("main_text", F.lit("own")).withColumn("text", F.lit("own"))
    got = [(r.page_id, len(r.main_text), r.text) for r in extract.extract(pages).orderBy("page_id").collect()]
    assert got == [(1, len(extract.main_text(PAGE)), "own")] * 2 + [(2, 0, "own"), (3, 0, "own"), (4, 6 * 30_000 - 2, "own")]
    assert extract.extract(pages.limit(0)).count() == 0


def test_extraction_query_against_the_pages_make(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in QUERIES["op4_html_extraction"](spark, SMALL).collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", x))).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
