"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Spark jobs hash the items' words and pack them into blocks of at most ``block_words`` words (a longer item comes in pieces that
share ``window - 1`` words, so no window is lost), written to the shared folder by number. The driver lists the numbers and
hands one block after the other to a broadcast, so what it holds and what one broadcast has are bounded, whatever the size of the
benchmark; the tables go once the blocks are broadcast. Every Python worker builds a block's automaton
once. Documents stream through: words that no item has reset the match, so only runs of item words step
through the automaton, which tracks the longest matching length. Blocks are passes chained over the same rows; there
is no shuffle, and the texts are never moved.

Defined cases: a null or empty text, or one without words, has no hits. A null item text has no words and so no
window. Items without an id take part in hits but can't be listed. Items that share an id count once. Repeated
documents are judged alike, each on its own row. An empty benchmark hits nothing. Extra columns of either table are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.automaton import SuffixAutomaton
from marketframe.llm.components import remove
from marketframe.llm.words import Words, pieces, spans_of
from marketframe.session import scratch_dir

KIND = "alnum_lower"
_built: dict = {}


class ItemIndex:
    """Automaton of a block of items: where windows of ``window`` words (or whole shorter items) end."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.least = min((len(w) for _, w in items), default=window)
        self.least = min(self.least, window)
        sam = self.sam = SuffixAutomaton(w for _, w in items)
        self.vocabulary = np.unique(np.fromiter((x for _, w in items for x in w), np.uint64))
        self.bloom = np.zeros(1 << 20, bool)
        self.bloom[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        # a window of length m ending in state s belongs to the ancestor a with length[link[a]] < m <= length[a]
        self.top = [self._ancestor(s, window) for s in range(len(sam))]
        self.ids: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for name, w in items:
            if len(w) >= window:
                for s in sam.walk(w)[window - 1 :]:
                    self.ids.setdefault(self.top[s], set()).add(name)
            elif w:
                self.short.setdefault(self._ancestor(sam.walk(w)[-1], len(w)), []).append((len(w), name))
        # a state's suffixes are those of its link as well, from the shortest states on
        if self.short:
            for s in sorted(range(1, len(sam)), key=sam.length.__getitem__):
                up = self.short.get(sam.link[s])
                if up:
                    self.short[s] = self.short.get(s, []) + up

    def _ancestor(self, s: int, m: int) -> int:
        link, length = self.sam.link, self.sam.length
        while s and length[link[s]] >= m:
            s = link[s]
        return s

    def known(self, h: np.ndarray) -> np.ndarray:
        out = self.bloom[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.searchsorted(self.vocabulary, h[at])
            out[at] = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == h[at]
        return out

    def hits(self, run: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges (start, end) of window occurrences in a run of item words, and the items they belong to."""
        go, link, length, window = self.sam.go, self.sam.link, self.sam.length, self.window
        at, n, spans, names = 0, 0, [], set()
        for i, c in enumerate(run, 1):
            while at and c not in go[at]:
                at = link[at]
                n = length[at]
            if c in go[at]:
                at = go[at][c]
                n += 1
            if n >= window:
                spans.append((i - window, i))
                names |= self.ids.get(self.top[at], set())
            if self.short:
                # the state reached may hold longer strings than what was matched: only lengths up to n count
                for m, name in self.short.get(at, ()):
                    if m <= n:
                        spans.append((i - m, i))
                        names.add(name)
        return spans, names


def item_words(benchmark: DataFrame, id_col: str, text_col: str, window: int, size: int) -> DataFrame:
    """``item, n, words`` (64-bit hashes) of the items that have words; of a longer item, pieces of ``size`` words that share
    ``window - 1``, so that each of its windows lies in one."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = batch.column("item").to_pylist(), []
            for first, w in pieces(batch.column("text"), KIND):
                for d in range(len(w.doc) - 1):
                    words = w.hash[w.doc[d] : w.doc[d + 1]]
                    for at in range(0, max(min(1, len(words)), len(words) - window + 1), size - window + 1):
                        part = words[at : at + size]
                        rows.append((names[first + d], len(part), part.tobytes()))
            item, n, words = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.string()), "n": pa.array(n, pa.int32()), "words": pa.array(words, pa.binary())})

    return benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).mapInArrow(step, "item string, n int, words binary")


def packed(items: DataFrame, size: int) -> DataFrame:
    """``items`` with the number of the ``block`` each is in: a task fills one block of at most ``size`` words after the other."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, words = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            block = []
            for n in batch.column("n").to_pylist():
                if words and words + n > size:
                    number, words = number + 1, 0
                words += n
                block.append(number)
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("words"), pa.array(block, pa.int64())], names=["item", "words", "block"])

    return items.mapInArrow(step, "item string, words binary, block bigint")


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items' word hashes, a block at a time."""
    spark, size = benchmark.sparkSession, max(block_words, window)
    folder = scratch_dir(spark, "items")
    item_words(benchmark, id_col, text_col, window, size).write.parquet(f"{folder}/items")
    items = spark.read.schema("item string, n int, words binary").parquet(f"{folder}/items")
    total = items.agg(F.sum("n")).first()[0] or 0
    packed(items.coalesce(max(1, -(-total // size))), size).write.partitionBy("block").parquet(f"{folder}/blocks")
    if total:
        table = spark.read.schema("item string, words binary, block bigint").parquet(f"{folder}/blocks")
        for number in sorted(r.block for r in table.select("block").distinct().collect()):
            yield [(r.item, bytes(r.words)) for r in table.where(F.col("block") == number).collect()]
    remove(spark, folder)


def _index(key: str, bc, window: int) -> ItemIndex:
    """A worker's automaton of a block; kept until it works on another block."""
    if key not in _built:
        _built.clear()
        _built[key] = ItemIndex([(item, np.frombuffer(words, np.uint64).tolist()) for item, words in bc.value], window)
    return _built[key]


def _marks(index: ItemIndex, w: Words) -> Iterator[tuple[int, np.ndarray, set]]:
    """(text, hit words, item ids) of the texts with hits."""
    if not len(w):
        return
    known = index.known(w.hash)
    first = np.zeros(len(w), bool)
    first[w.doc[:-1][w.doc[:-1] < len(w)]] = True
    head = known & (first | ~np.concatenate([[False], known[:-1]]))
    starts = np.flatnonzero(head)
    if not len(starts):
        return
    stop = np.flatnonzero(~known | first)
    ends = np.append(stop, len(w))[np.searchsorted(stop, starts, "right")]
    keep = ends - starts >= index.least
    found: dict[int, tuple[np.ndarray, set]] = {}
    for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
        spans, names = index.hits(w.hash[s:e].tolist())
        if spans:
            d = int(np.searchsorted(w.doc, s, "right")) - 1
            at = int(w.doc[d])
            if d not in found:
                found[d] = np.zeros(int(w.doc[d + 1]) - at, bool), set()
            mask, ids = found[d]
            for a, b in spans:
                mask[s + a - at : s + b - at] = True
            ids |= names
    for d, (mask, ids) in found.items():
        yield d, mask, ids


def hit_spans(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, block_words: int = 200_000) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word ranges [start, end) that windows of items cover, disjoint and
    in order; words are those of the ``alnum_lower`` rule) and ``hit_items`` (sorted item ids). Columns of these names are
    replaced."""
    sc = docs.sparkSession.sparkContext
    out = docs.withColumns({"n_words": F.lit(None).cast("long"), "hit_spans": F.array().cast("array<array<long>>"), "hit_items": F.array().cast("array<string>")})
    schema = out.schema
    parts = [sc.broadcast(b) for b in blocks(benchmark, item_id, item_text, window, block_words)] or [sc.broadcast([])]

    def one(bc):
        key = uuid.uuid4().hex

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(key, bc, window)
            for batch in batches:
                column = batch.column(text_col)
                n, spans, items = [], batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist()
                for first, w in pieces(column, KIND):
                    n += np.diff(w.doc).tolist()
                    for d, mask, ids in _marks(index, w):
                        for a, b in spans[first + d] or ():
                            mask[a:b] = True
                        spans[first + d] = spans_of(mask)
                        items[first + d] = sorted({*items[first + d], *(i for i in ids if i is not None)})
                new = {"n_words": pa.array(n, pa.int64()), "hit_spans": pa.array([[list(x) for x in s] for s in spans], batch.schema.field("hit_spans").type), "hit_items": pa.array(items, batch.schema.field("hit_items").type)}
                yield pa.RecordBatch.from_arrays([new.get(k, batch.column(k)) for k in batch.schema.names], schema=batch.schema)

        return step

    for bc in parts:
        out = out.mapInArrow(one(bc), schema)
    return out


def verdicts(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", coverage: tuple[int, int] = (1, 20), **options) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated (at least one hit word, and hit words at
    least the share ``coverage`` of all, a fraction in whole numbers)."""
    spans = hit_spans(docs.select(F.col(id_col), F.col(text_col).alias("text")), benchmark, **options)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return spans.select(
        F.col(id_col), "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), ((hit > 0) & (hit * coverage[1] >= F.col("n_words") * coverage[0])).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", max_span: int | None = None, coverage: tuple[int, int] = (1, 20), drop: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` after decontamination. A document whose hit words reach ``coverage`` is contaminated: with
    ``drop`` it goes, else its hit spans are cut from its text. In the others, spans of over ``max_span`` words
    are cut (none, if that is None). A cut takes the bytes from the span's first word to the next kept word."""
    names = docs.columns
    keep = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    spans = hit_spans(keep, benchmark, **options)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    spans = spans.withColumn("bad", (hit > 0) & (hit * coverage[1] >= F.col("n_words") * coverage[0]))
    if drop:
        spans = spans.where(~F.col("bad"))
    wide = F.filter("hit_spans", lambda s: s[1] - s[0] > F.lit(max_span)) if max_span is not None else F.array().cast("array<array<long>>")
    spans = spans.withColumn("cut", F.when(F.col("bad"), F.col("hit_spans")).otherwise(wide))
    if max_span is not None or not drop:
        spans = spans.mapInArrow(_cut, spans.schema)
    return spans.select(*[(F.col("text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        cuts = batch.column("cut").to_pylist()
        if any(cuts):
            for first, w in pieces(batch.column("text"), KIND):
                for d in range(len(w.doc) - 1):
                    if spans := cuts[first + d]:
                        a, b, at, kept = int(w.offsets[d]), int(w.offsets[d + 1]), int(w.doc[d]), []
                        for s, e in spans:
                            kept.append(w.data[a : int(w.start[at + s])].tobytes())
                            a = int(w.start[at + e]) if at + e < int(w.doc[d + 1]) else b
                        texts[first + d] = b"".join([*kept, w.data[a:b].tobytes()]).decode("utf-8", "replace")
        yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field("text").type) if k == "text" else batch.column(k) for k in batch.schema.names], schema=batch.schema)


def item_ids_digest(ids: list[str]) -> str:
    """What ``items_sha256`` holds for these ids."""
    return hashlib.sha256(",".join(sorted(set(ids))).encode()).hexdigest()
