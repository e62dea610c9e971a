"""Substring dedup: words covered by a window of ``length`` words that also starts anywhere else are removed.

Suffix automata of reference shards decide: documents are streamed through them for matching statistics, and spans of at least ``length`` words that
match elsewhere are removed. One automaton of a whole corpus, or every document against every shard, would not scale, so anchors say which
passages of which documents meet which shard, and nothing more:

1. Anchors. Of every window, the 17-word gram of the smallest hash (a minimizer) is its anchor; equal windows have equal anchors at equal places. Anchors
   are dealt out by hash, and those that occur once drop out, and with them all their windows.
2. Passages. The windows of one anchor's occurrence follow each other; the words they cover are its passage. Passages are dealt to shards by anchor, so all that can
   match a window meets it in one shard, and each window of a text is in one passage. Equal passages of a piece of text go as one, with their number: the others are
   repeated whole, as the first will be found to be, and go on by text, so that a common passage is not one task's work. A task sends a passage's words once.
3. Shards. A shard's distinct passages are its reference; those that are part of others add nothing to its automaton. All are streamed through it: the state where
   the statistic reaches ``length`` tells the window, and its occurrences are counted there. Windows with two or more are the spans to remove.
   A shard is a run of whole anchors of about ``SHARD`` passages.
4. Removal. The spans go back to the texts by key.

Texts that occur twice are one text to all this (all their windows are repeated: they are removed whole if they have ``length`` words). The texts are shuffled
once, by key, and that exchange is used three times; the anchors' rows are fixed-size, about one for ten words.

Defined cases: a null text has no words; texts shorter than ``length`` lose nothing; repeated rows are repeated texts, whatever their ids. Windows are judged on the
input. Extra columns are ignored. An empty table gives an empty result. Words are compared by 64-bit hashes, passages and texts by 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.automaton import SuffixAutomaton
from marketframe.llm.words import Words, pieces

KIND = "space"
#: Distinct passages from which a shard is full.
SHARD = 2000


def _gram(length: int) -> int:
    return max(1, length // 2)


class Anchors:
    """Anchors of a piece's windows: word place, token, and first window and number of windows."""

    def __init__(self, w: Words, length: int):
        k = _gram(length)
        grams, span = w.grams(k), length - k + 1
        n = len(w) - length + 1
        self.place = self.first = self.count = self.owner = np.zeros(0, np.int64)
        self.token = np.zeros(0, np.int64)
        if n <= 0:
            return
        value, at, done = grams, np.arange(len(grams)), 1

        def least(value, at, step, size):
            a, b = value[:size], value[step : step + size]
            left = a <= b
            return np.where(left, a, b), np.where(left, at[:size], at[step : step + size])

        while 2 * done <= span:
            value, at = least(value, at, done, len(value) - done)
            done *= 2
        value, at = least(value, at, span - done, n)
        inside = w.left()[:n] >= length
        start = np.flatnonzero(inside & np.concatenate([[True], (at[1:] != at[:-1]) | ~inside[:-1]]))
        stop = np.concatenate([start[1:], [n]])
        # windows that run over a text's end stand between
        total = np.concatenate([[0], np.cumsum(inside)])
        self.first, self.count = start, total[stop] - total[start]
        self.place, self.token = at[start], grams[at[start]].view(np.int64)
        self.owner = np.searchsorted(w.doc, start, "right") - 1


def _groups(batches: Iterator[pa.RecordBatch], rows_at_least: int = 100_000) -> Iterator[pa.Table]:
    """Tables of whole tokens from batches in order of token."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows += batch.num_rows
        t = batch.column("token").to_numpy()
        if rows < rows_at_least or t[0] == t[-1]:
            continue
        cut = int(np.searchsorted(t, t[-1], "left"))
        yield pa.Table.from_batches([*kept[:-1], batch.slice(0, cut)])
        kept, rows = [batch.slice(cut)], batch.num_rows - cut
    if kept:
        yield pa.Table.from_batches(kept)


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``key, places`` (word places of anchors that occur elsewhere, too) of texts (key, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, w in pieces(batch.column("text"), KIND):
                a = Anchors(w, length)
                new = np.array([not (k in seen or seen.add(k)) for k in keys[first : first + len(w.doc) - 1].tolist()], bool)[a.owner]
                token, key, place = a.token[new], keys[first + a.owner[new]], (a.place - w.doc[a.owner])[new].astype(np.int32)
                # what a piece holds several times is known to be repeated: it goes on by text, and one of them tells the others
                _, head, at, count = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
                known = count[at] > 1
                tell = np.zeros(len(token), bool)
                tell[head] = True
                rows = np.concatenate([np.flatnonzero(known), np.flatnonzero(tell)])
                final = np.arange(len(rows)) < known.sum()
                yield pa.RecordBatch.from_pydict({"part": np.where(final, key[rows], token[rows]), "token": token[rows], "key": key[rows], "place": place[rows], "final": pa.array(final)})

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            final = t.column("final").to_numpy().astype(bool)
            token, key, place = (t.column(c).to_numpy() for c in ("token", "key", "place"))
            yield pa.RecordBatch.from_pydict({"key": key[final], "place": place[final]})
            token, key, place = token[~final], key[~final], place[~final]
            again = np.concatenate([[False], (token[1:] == token[:-1]) & (key[1:] == key[:-1]) & (place[1:] == place[:-1])]) if len(token) else np.zeros(0, bool)
            token, key, place = token[~again], key[~again], place[~again]
            same = token[1:] == token[:-1]
            many = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(token) else same
            yield pa.RecordBatch.from_pydict({"key": key[many], "place": place[many]})

    dealt = texts.mapInArrow(emit, "part bigint, token bigint, key bigint, place int, final boolean").repartition("part").sortWithinPartitions("token", "key", "place")
    return dealt.mapInArrow(several, "key bigint, place int").groupBy("key").agg(F.collect_set("place").alias("places"))


def passages(candidates: DataFrame, length: int) -> DataFrame:
    """``token, copy, pid, key, start, n, words``: the passages of repeated anchors of texts with their places (key, text, places). The first of the equal
    passages of a piece tells their number n, and has the words if its task has not sent them yet; the others are copies, dealt by text, and n their words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            keys, places = batch.column("key").to_numpy(), batch.column("places")
            for first, w in pieces(batch.column("text"), KIND):
                a, wanted = Anchors(w, length), np.zeros(len(w), bool)
                for d in range(len(w.doc) - 1):
                    if (k := int(keys[first + d])) not in seen:
                        seen.add(k)
                        wanted[w.doc[d] + np.asarray(places[first + d].values)] = True
                use = np.flatnonzero(wanted[a.place]) if len(a.place) else a.place
                begin = a.first[use]
                end = begin + a.count[use] + length - 1
                token, key, pid = a.token[use], keys[first + a.owner[use]], w.range_hash(begin, end).view(np.int64)
                order = np.lexsort((begin, pid, token))
                new = _changes(token[order], pid[order])
                n, copy = (end - begin).astype(np.int32), np.ones(len(use), bool)
                copy[order[new]] = False
                n[order[new]] = np.diff(np.append(np.flatnonzero(new), len(use)))
                words: list[bytes | None] = [None] * len(use)
                if len(sent) > SENT:
                    sent.clear()
                for i in np.flatnonzero(~copy).tolist():
                    if (name := (int(token[i]), int(pid[i]))) not in sent:
                        sent.add(name)
                        words[i] = w.data[int(w.start[begin[i]]) : int(w.end[end[i] - 1])].tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.where(copy, key, token)), pa.array(copy), pa.array(pid), pa.array(key), pa.array((begin - w.doc[a.owner[use]]).astype(np.int32)), pa.array(n), pa.array(words, pa.binary()),
                ], names=["token", "copy", "pid", "key", "start", "n", "words"])

    return candidates.mapInArrow(emit, "token bigint, copy boolean, pid bigint, key bigint, start int, n int, words binary")


#: Names of passages that a task remembers to have sent.
SENT = 200_000


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _ranges(x: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """x[start:start+count] of each range, one after the other."""
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return x[np.repeat(start, count) + place]


def repeated_spans(shard: list[np.ndarray], times: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Of each passage (word hashes) of a shard, the spans of windows of ``length`` words that occur twice or more in it, where passages occur so many ``times``."""
    sam = SuffixAutomaton()
    texts = [p.tolist() for p in shard]
    for words in sorted(texts, key=len, reverse=True):
        if sam.matching(words)[-1] < len(words):
            sam.add(words)
    link, longest = sam.link, sam.length
    window: dict[int, int] = {}  # state -> the state of its suffixes of ``length`` words
    found: dict[int, int] = {}
    ends: list[list[int]] = []
    for words, n in zip(texts, times, strict=True):
        states = sam.walk(words)[length - 1 :]
        for i, s in enumerate(states):
            if (at := window.get(s)) is None:
                at = s
                while longest[link[at]] >= length:
                    at = link[at]
                window[s] = at
            states[i] = at
            found[at] = found.get(at, 0) + n
        ends.append(states)
    out = []
    for states in ends:
        spans: list[tuple[int, int]] = []
        for i, at in enumerate(states):
            if found[at] > 1:
                if spans and spans[-1][1] == i + length - 1:
                    spans[-1] = (spans[-1][0], i + length)
                else:
                    spans.append((i, i + length))
        out.append(spans)
    return out


def shard_spans(dealt: DataFrame, length: int) -> DataFrame:
    """``key, start, end`` of the spans to remove, of passages in order of token, pid, whole tokens in one partition."""
    size = SHARD

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 10_000):
            copy = t.column("copy").to_numpy().astype(bool)
            key, start, n = (t.column(c).to_numpy()[copy] for c in ("key", "start", "n"))
            yield pa.RecordBatch.from_pydict({"key": pa.array(key), "start": pa.array(start), "end": pa.array(start + n)})
            t = t.filter(pa.array(~copy))
            if not t.num_rows:
                continue
            token, pid, key, start, n = (t.column(c).to_numpy() for c in ("token", "pid", "key", "start", "n"))
            new = _changes(token, pid)
            at = np.cumsum(new) - 1
            times = np.bincount(at, n).astype(np.int64).tolist()
            words = t.column("words").combine_chunks()
            have = np.flatnonzero(words.is_valid().to_numpy(zero_copy_only=False))
            reference = words.take(pa.array(have[np.unique(at[have], return_index=True)[1]]))
            hashes = [w.hash[w.doc[d] : w.doc[d + 1]] for _, w in pieces(reference, KIND) for d in range(len(w.doc) - 1)]
            spans: list[list[tuple[int, int]]] = []
            ends = np.append(np.flatnonzero(_changes(token[new])), len(hashes)).tolist()[1:]
            for stop in ends:
                if stop - len(spans) >= size or stop == len(hashes):
                    spans += repeated_spans(hashes[len(spans) : stop], times[len(spans) : stop], length)
            count = np.array([len(x) for x in spans], np.int64)
            flat = np.array([x for s in spans for x in s], np.int32).reshape(-1, 2)
            row = np.repeat(np.arange(len(token)), count[at])
            which = _ranges(np.arange(len(flat)), (np.cumsum(count) - count)[at], count[at])
            yield pa.RecordBatch.from_pydict({"key": pa.array(key[row]), "start": pa.array(start[row] + flat[which, 0]), "end": pa.array(start[row] + flat[which, 1])})

    return dealt.mapInArrow(decide, "key bigint, start int, end int")


def with_keys(texts: DataFrame, key: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """``texts`` with the ``key`` of each text. Texts that share a key but not a second, independent hash get keys of their own; where there are none such,
    which is as good as always, nothing but the hashes is shuffled."""
    rows = texts.withColumn("key", key("text")).withColumn("second", F.xxhash64(F.lit(1), "text"))
    clash = rows.groupBy("key").agg(F.min("second").alias("first"), F.max("second").alias("most")).where(F.col("first") != F.col("most")).select("key", "first")
    if not clash.isEmpty():
        rows = rows.join(clash, "key", "left")
        rows = rows.withColumn("key", F.when(F.col("first").isNull() | (F.col("first") == F.col("second")), F.col("key")).otherwise(F.xxhash64("second", "key")))
    return rows.select("id", "key", "text")


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 35, key: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """Per document: id, n_words, n_removed and kept (the words that stay, joined by one space)."""
    rows = with_keys(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), key)
    texts = rows.repartition("key")  # one exchange for the three times the texts are needed
    anchors = repeated_anchors(rows.select("key", "text"), length)
    dealt = passages(texts.join(anchors, "key").select("key", "text", "places"), length).repartition("token").sortWithinPartitions("token", "pid")
    spans = shard_spans(dealt, length)
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    out = texts.join(spans, "key", "left").join(copies, "key", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans, copies in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                words = (text or b"").split()  # ASCII white space is what parts words
                n.append(len(words))
                if copies and len(words) >= length:
                    words = []
                elif spans:
                    stay = np.ones(len(words), bool)
                    for s in spans:
                        stay[s["start"] : s["end"]] = False
                    words = list(compress(words, stay.tolist()))
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[id_col, "n_words", "n_removed", "kept"])

    return out.select("id", "text", "spans", "copies").mapInArrow(cut, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words bigint, n_removed bigint, kept string")
