"""Word arrays and automata against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from marketframe.llm.automaton import SuffixAutomaton
from marketframe.llm.words import pieces, rolling, spans_of
from tests.llm.data import ALNUM, WORD, documents, folded


@pytest.mark.parametrize("kind", ["space", "space_lower", "alnum_lower"])
def test_words_are_those_of_the_pattern(kind):
    texts = [t for _, t, _ in documents()] + ["a", "", "b ", " c", None, "Ab9-é_x\x7fz", "\x00q"]
    got = [w.data[s:e].tobytes().decode() for _, w in pieces(pa.array(texts).slice(2), kind) for s, e in zip(w.start, w.end, strict=True)]
    want = [x for t in texts[2:] for x in (ALNUM if kind == "alnum_lower" else WORD).findall(folded(t) if kind == "alnum_lower" else t or "")]
    assert got == want or kind == "alnum_lower" and [folded(x) for x in got] == want


def test_hashes_follow_words_alone():
    a, b = ([w for _, w in pieces(pa.array([t]), "space_lower")][0] for t in ("One two three four one two", " ONE\n\ntwo  three\tfour One two"))
    assert (a.hash == b.hash).all() and a.hash[0] == a.hash[4] != a.hash[1]
    assert (a.grams(2) == b.grams(2)).all() and len(set(a.grams(2).tolist())) == 4


@pytest.mark.parametrize("k", [1, 2, 3, 5, 13, 17, 35])
def test_rolling_hash_tells_windows_apart(k):
    x = np.array([random.Random(k).randrange(3) for _ in range(400)], np.uint64)
    h = rolling(x, k)
    assert len(h) == 400 - k + 1
    by = {}
    for i, v in enumerate(h.tolist()):
        assert by.setdefault(tuple(x[i : i + k].tolist()), v) == v
    assert len(set(by.values())) == len(by)


def test_automaton_matching_statistics():
    r = random.Random(3)
    for _ in range(60):
        texts = ["".join(r.choice("ab") for _ in range(r.randrange(12))) for _ in range(3)]
        sam = SuffixAutomaton(texts)
        q = "".join(r.choice("abc") for _ in range(15))
        want = [max(n for n in range(i + 1) if any(q[i - n : i] in t for t in texts)) for i in range(1, len(q) + 1)]
        assert sam.matching(q) == want
        assert len(sam) <= 2 * sum(map(len, texts)) + 1
        for t in texts:
            assert len(sam.walk(t)) == len(t)


def test_spans_of():
    assert spans_of(np.array([True, False, True, True])) == [(0, 1), (2, 4)] and spans_of(np.zeros(0, bool)) == []
