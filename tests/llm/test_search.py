"""Ranked search against brute force over whole texts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import search
from tests.llm.data import ALNUM, documents, folded, frame, prose


def brute(rows, items, top=10):
    """(item's place, rank, doc_id, score)."""
    texts = [(i, Counter(ALNUM.findall(folded(t)))) for i, t, *_ in rows]
    sizes = [sum(c.values()) for _, c in texts]
    n_docs, n_words, df = sum(n > 0 for n in sizes), sum(sizes), Counter(t for _, c in texts for t in c)
    out = []
    for k, (_, text) in enumerate(items):
        asked = Counter(ALNUM.findall(folded(text)))
        found = []
        for (i, c), n in zip(texts, sizes, strict=True):
            m = 100 - 75 + 75 * n * n_docs // n_words
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                found.append((-s, i is not None, i or 0))
        out += [(k, r, i if there else None, -s) for r, (s, there, i) in enumerate(sorted(found)[:top], 1)]
    return out


def ask(spark, rows, items, **how):
    asked = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(items)], "item_id int, text string").withColumns({c: F.lit("own") for c in ("bundle", "rank", "shard", "score", "doc_id")})
    return sorted(map(tuple, search.search(frame(spark, rows), asked, **how).collect()), key=repr)


ITEMS = [(0, prose(2, 60)), (1, prose(1, 30) + " edit3x0 EDIT3X1"), (2, "again"), (3, None), (4, ""), (5, "!?"), (6, "One, TWO: x"), (7, "nowhere to be found"), (8, prose(2, 60)), (9, "aé"), (10, " ".join(prose(7, 6000, 3000).split()[:900])), (11, "Subscribe to our page " * 40), (12, "y" * 100_000)]


@pytest.mark.parametrize("how", [{}, {"shard_docs": 7, "bundle_items": 3}, {"shard_docs": 1, "bundle_items": 1, "top": 3}])
def test_search(spark, how):
    rows = documents()
    assert ask(spark, rows, ITEMS, **how) == sorted(brute(rows, ITEMS, how.get("top", 10)), key=repr)


def test_pruned_accumulators_lose_nothing(spark):
    # words of every commonness, by Zipf's rule, so that all owners have terms and bounds bite
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i * 3 % 2000, " ".join(r.choices(words, weights, k=r.randint(1, 60))), "s") for i in range(1500)]
    rows += [(5000 + i, rows[0][1], "s") for i in range(300)]  # copies: equal scores
    items = [(k, " ".join(r.choices(words, weights, k=r.randint(1, 25)))) for k in range(30)] + [(30, rows[0][1])]
    assert ask(spark, rows, items, shard_docs=200, bundle_items=8) == sorted(brute(rows, items), key=repr)


def test_empty_tables(spark):
    assert ask(spark, [], ITEMS) == [] and ask(spark, documents(), []) == [] and ask(spark, [(1, None, "s"), (2, "", "s")], ITEMS) == []


def test_term_table_holds_every_term(spark):
    terms = spark.createDataFrame([(i * 2654435761 * (-1) ** i,) for i in range(5000)], "term long")
    bits = search.term_bits(terms)
    slots = {r.term & (search.SLOTS - 1) for r in terms.collect()}
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == slots
