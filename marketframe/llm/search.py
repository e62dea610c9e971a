"""Ranked lexical search by pipelined term partitioning.

Terms are owned by stages, the rarest by the first, those in over a tenth of the documents by the last (``OWNERS``). Documents are cut into shards of
``SHARD`` and items into bundles of ``BUNDLE``. For each shard a bundle carries sparse accumulators (item, document, score) from stage to stage: it meets the
owner's postings of the shard by cogroup, and the owner adds the integer contributions of its terms. After each stage an accumulator goes
only if it cannot come among its item's ten any more: contributions are never negative and a term's is under a million times its weight, so the score so far and the bound of
the terms to come are below the tenth best of the shard. For the same reason a stage opens no new accumulators for an item whose tenth best is above that bound. The
last stage gives each item's ten best of the shard, and those of all shards are ranked. All this is exact: scores are 64-bit integers.

Only terms of items are posted. Which those are goes to the tasks as a table of 2 ** 24 bits, whatever the number of items; a term that shares a bit only costs its
postings. Terms in over a hundredth of the documents go to the tasks with their owner: there are at most a hundred times as many as a document has
distinct terms on average. A group is one shard with one bundle, so its size is bounded; every bundle meets every shard, which is the task set (items against all
documents, in blocks). Terms are compared by 64-bit hashes.

Defined cases: null and empty texts have no terms, are not counted and never found; an item without terms, or whose terms no document has, has no rows. Rows of ``items`` with one id are
items of their own, as are repeated documents. Null ids come first among equal scores. Empty tables give no rows. Texts are read whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.components import written
from marketframe.llm.words import Words, pieces

SHARD = 4096
BUNDLE = 100
BUNDLE_TERMS = 20_000
SLOTS = 1 << 24
#: A term in over this share of the documents belongs to the next owner.
OWNERS = (0.01, 0.1)
#: Contributions are weights times less than this.
UNIT = 1_000_000

_POSTS = pa.schema([
    ("shard", pa.int64()), ("full", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("n", pa.binary()),
    ("terms", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary()),
])
POSTS = "shard long, full long, words long, ids array<long>, n binary, terms binary, counts binary, docs binary, tfs binary"
_STATE = pa.schema([("shard", pa.int64()), ("bundle", pa.int64()), ("size", pa.int32()), ("item", pa.binary()), ("term", pa.binary()), ("gain", pa.binary()), ("owner", pa.binary()), ("floor", pa.binary()), ("acc_item", pa.binary()), ("acc_doc", pa.binary()), ("acc", pa.binary())])
STATE = "shard long, bundle long, size int, item binary, term binary, gain binary, owner binary, floor binary, acc_item binary, acc_doc binary, acc binary"


def term_counts(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of the distinct terms of each text."""
    return _counted(w.owner(), w.hash)


def _counted(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    head = np.ones(len(term), bool)
    head[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(head)
    return text[at], term[at], np.diff(np.append(at, len(term)))


def item_terms(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", bundle_items: int = BUNDLE) -> DataFrame:
    """(bundle, item, item_id, term, count): the terms of each item with terms; bundles are of ``bundle_items`` items or ``BUNDLE_TERMS`` terms."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle, item, terms = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            ids = batch.column("item_id")
            for first, w in pieces(batch.column("text"), "alnum_lower"):
                text, term, count = term_counts(w)
                cut = np.searchsorted(text, np.arange(len(w.doc)))
                for k in np.flatnonzero(np.diff(cut)):
                    a, b = cut[k], cut[k + 1]
                    if item and (item >= bundle_items or terms + b - a > BUNDLE_TERMS):
                        bundle, item, terms = bundle + 1, 0, 0
                    n = int(b - a)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, part << 32 | bundle)), pa.array(np.full(n, item, np.int32)), pa.array(ids.slice(first + int(k), 1).to_pylist() * n, ids.type), pa.array(term[a:b].view(np.int64)), pa.array(count[a:b])],
                        names=["bundle", "item", "item_id", "term", "count"],
                    )
                    item, terms = item + 1, terms + n

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, f"bundle long, item int, item_id {rows.schema['item_id'].dataType.simpleString()}, term long, count long")


def term_bits(terms: DataFrame) -> np.ndarray:
    """A table of ``SLOTS`` bits (2 MB) with the bit of each ``term`` set."""
    slot = terms.select(F.col("term").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).distinct()
    parts = slot.groupBy(F.expr("slot div 32768").alias("k")).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits"))
    out = np.zeros(SLOTS >> 3, np.uint8)
    for r in parts.collect():  # 512 rows of 4 KB at most
        out[r["k"] << 12 : (r["k"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def postings(docs: DataFrame, bits: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD) -> DataFrame:
    """The shards: documents in order of their ids, their lengths, and the postings of the terms whose bit is set, by term."""
    table = docs.sparkSession.sparkContext.broadcast(bits)

    def shard(number: int, ids: list, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0)), np.int64)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = place[doc]
        by = np.lexsort((doc, term))
        term, doc, tf = term[by], doc[by], tf[by]
        distinct, count = np.unique(term, return_counts=True)
        row = [number, int((n > 0).sum()), int(n.sum()), [ids[i] for i in order], n[order].tobytes(), distinct.tobytes(), count.astype(np.int32).tobytes(), doc.astype(np.uint16).tobytes(), tf.astype(np.int32).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _POSTS, strict=True)], schema=_POSTS)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, wanted = TaskContext.get().partitionId(), 0, table.value
        ids: list = []
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal ids, held, made
            out = shard(part << 32 | made, ids, *[np.concatenate(c) for c in zip(*held, strict=True)])
            ids, held, made = [], [], made + 1
            return out

        for batch in batches:
            for k in range(0, batch.num_rows, shard_docs):
                some = batch.slice(k, shard_docs)
                new = some.column("id").to_pylist()
                for first, w in pieces(some.column("text"), "alnum_lower"):
                    slot = (w.hash & np.uint64(SLOTS - 1)).astype(np.int64)
                    mine = (wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                    text, term, tf = _counted(w.owner()[mine], w.hash[mine])
                    held.append((np.diff(w.doc).astype(np.int64), text + len(ids), term, tf))
                    ids += new[first : first + len(w.doc) - 1]
                if len(ids) >= shard_docs:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, POSTS)


def document_frequencies(posts: DataFrame) -> DataFrame:
    """(term, df) of the posted terms."""
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, np.int64)), pa.array(np.frombuffer(counts, np.int32).astype(np.int64))], schema=schema)

    return posts.select("terms", "counts").mapInArrow(step, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _owned(posts: DataFrame, owner: int, widely: np.ndarray, owners: np.ndarray, n_docs: int, n_words: int) -> DataFrame:
    """Of each shard the postings of an owner's terms, as (term, documents, contribution for a weight of one)."""
    table = posts.sparkSession.sparkContext.broadcast((widely, owners))
    schema = pa.schema([("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("terms", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("units", pa.binary())])
    last = owner == len(OWNERS)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = table.value
        for batch in batches:
            for i in range(batch.num_rows):
                number, n, terms, counts, docs, tfs = (batch.column(c)[i].as_py() for c in ("shard", "n", "terms", "counts", "docs", "tfs"))
                n, terms, counts, docs, tfs = (np.frombuffer(b, t) for b, t in ((n, np.int64), (terms, np.int64), (counts, np.int32), (docs, np.uint16), (tfs, np.int32)))
                at = np.searchsorted(known, terms)
                at[at == len(known)] = 0
                mine = (np.where(known[at] == terms, of[at], 0) if len(known) else np.zeros(len(terms), np.int8)) == owner
                posts_mine = np.repeat(mine, counts)
                docs, tf = docs[posts_mine], tfs[posts_mine].astype(np.int64)
                m = 100 - 75 + 75 * n * n_docs // n_words
                unit = 1_000_000_000 * tf // (1000 * tf + 8 * m[docs])
                row = [number, batch.column("ids")[i].as_py() if last else None, terms[mine].tobytes(), counts[mine].tobytes(), docs.tobytes(), unit.astype(np.int32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    wanted = ("shard", "n", "terms", "counts", "docs", "tfs") + (("ids",) if last else ())
    return posts.select(*wanted).mapInArrow(step, "shard long, ids array<long>, terms binary, counts binary, docs binary, units binary")


def _bundles(entries: DataFrame) -> DataFrame:
    """A row a bundle, without a shard: its items' terms with weight times count (``gain``) and owner; no accumulators."""

    def pack(rows: pa.Table) -> pa.Table:
        a = {c: rows.column(c).to_numpy() for c in ("item", "term", "gain", "owner")}
        by = np.argsort(a["term"], kind="stable")
        size = int(a["item"].max()) + 1
        none = np.zeros(0, np.int64).tobytes()
        row = [0, rows.column("bundle")[0].as_py(), size, a["item"][by].astype(np.int32).tobytes(), a["term"][by].tobytes(), a["gain"][by].tobytes(), a["owner"][by].astype(np.int8).tobytes(), np.zeros(size, np.int64).tobytes(), none, none, none]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, _STATE, strict=True)], schema=_STATE)

    return entries.select("bundle", "item", "term", "gain", "owner").groupBy("bundle").applyInArrow(pack, STATE).drop("shard")


def _stage(owner: int, top: int):
    """What an owner does with a bundle at a shard; the last one returns the items' best documents."""
    last = owner == len(OWNERS)

    def add(state: pa.Table, posts: pa.Table) -> pa.Table:
        one = {c: state.column(c)[0].as_py() for c in state.schema.names}
        item, term, gain, own = (np.frombuffer(one[c], t) for c, t in (("item", np.int32), ("term", np.int64), ("gain", np.int64), ("owner", np.int8)))
        floor = np.frombuffer(one["floor"], np.int64).copy()
        at_item, at_doc, score = (np.frombuffer(one[c], t) for c, t in (("acc_item", np.int32), ("acc_doc", np.uint16), ("acc", np.int64)))
        terms, counts, docs, units = (np.frombuffer(posts.column(c)[0].as_py(), t) for c, t in (("terms", np.int64), ("counts", np.int32), ("docs", np.uint16), ("units", np.int32)))
        size = one["size"]
        width = 1 + max(int(docs.max(initial=0)), int(at_doc.max(initial=0)))
        acc = np.zeros((size, width), np.int64)
        acc[at_item, at_doc] = score
        # what an item's terms can still add, from this owner on and after it
        rest = [np.bincount(item, weights=np.where(own >= o, gain, 0), minlength=size).astype(np.int64) * UNIT for o in (owner, owner + 1)]
        closed = (rest[0] < floor)[:, None] & (acc == 0)
        ends = np.cumsum(counts)
        mine = np.flatnonzero(own == owner)
        low, high = np.searchsorted(term[mine], terms, "left"), np.searchsorted(term[mine], terms, "right")
        for k in np.flatnonzero(high > low):
            rows = mine[low[k] : high[k]]
            posted = slice(ends[k] - counts[k], ends[k])
            acc[np.ix_(item[rows], docs[posted])] += gain[rows][:, None] * units[posted].astype(np.int64)
        acc[closed] = 0
        if width >= top:
            floor = np.maximum(floor, np.partition(acc, width - top, axis=1)[:, width - top])
        if not last:
            keep = (acc > 0) & (acc + rest[1][:, None] >= floor[:, None])
            at_item, at_doc = np.nonzero(keep)
            one |= {"floor": floor.tobytes(), "acc_item": at_item.astype(np.int32).tobytes(), "acc_doc": at_doc.astype(np.uint16).tobytes(), "acc": acc[at_item, at_doc].tobytes()}
            return pa.table([pa.array([one[f.name]], f.type) for f in _STATE], schema=_STATE)
        at_item, at_doc = np.nonzero((acc > 0) & (acc >= floor[:, None]))
        score = acc[at_item, at_doc]
        by = np.lexsort((at_doc, -score, at_item))  # documents are in order of their ids
        at_item, at_doc, score = at_item[by], at_doc[by], score[by]
        best = np.arange(len(by)) - np.searchsorted(at_item, at_item) < top
        ids = posts.column("ids").combine_chunks().values
        return pa.table({"bundle": pa.array(np.full(int(best.sum()), one["bundle"])), "item": pa.array(at_item[best].astype(np.int32)), "doc_id": ids.take(pa.array(at_doc[best])), "score": pa.array(score[best])})

    return add


def search(docs: DataFrame, items: DataFrame, *, top: int = 10, shard_docs: int = SHARD, bundle_items: int = BUNDLE) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents. ``shard_docs`` is at most 32,768."""
    asked = written(item_terms(items, bundle_items=bundle_items), "asked")
    posts = written(postings(docs, term_bits(asked), shard_docs=shard_docs), "posts")
    n_docs, n_words, shards = posts.agg(F.coalesce(F.sum("full"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)), F.count(F.lit(1))).first()
    # only the terms that are asked for; those that share a bit with one go
    wanted = asked.select("term").distinct()
    df = written(document_frequencies(posts).join(wanted, "term", "left_semi"), "frequencies")
    owner = sum((F.when(F.col("df") > F.lit(share * n_docs), 1).otherwise(0) for share in OWNERS), F.lit(0))
    wide = df.where(F.col("df") > OWNERS[0] * n_docs).select("term", owner.alias("owner")).toPandas().sort_values("term")  # at most 1 / OWNERS[0] times a document's distinct terms
    widely, owners = wide["term"].to_numpy(np.int64), wide["owner"].to_numpy(np.int8)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    entries = asked.join(df, "term").select("bundle", "item", "term", (F.col("count") * weight).alias("gain"), owner.alias("owner"))
    # every bundle meets every shard: by salt, so that neither side is in one task
    salts = max(1, -(-shards // 64))
    salt = F.pmod(F.xxhash64("shard"), F.lit(salts))
    bundles = _bundles(entries).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    state = posts.select("shard", salt.alias("salt")).join(bundles, "salt").select(_STATE.names)
    meets = posts.select("shard", salt.alias("salt")).join(bundles.select("bundle", "salt"), "salt").select("shard", "bundle")
    out = None
    for o in range(len(OWNERS) + 1):
        owned = _owned(posts, o, widely, owners, n_docs, n_words).join(meets, "shard")
        owned = owned.toDF(*owned.columns)  # columns of its own: both sides descend from the same tables
        last = o == len(OWNERS)
        schema = "bundle long, item int, doc_id long, score long" if last else STATE
        out = state = state.groupBy("shard", "bundle").cogroup(owned.groupBy("shard", "bundle")).applyInArrow(_stage(o, top), schema)
    ranked = out.withColumn("rank", F.expr("row_number() over (partition by bundle, item order by score desc, doc_id nulls first)")).where(F.col("rank") <= top)
    names = asked.select("bundle", "item", "item_id").distinct()
    return ranked.join(names, ["bundle", "item"]).select("item_id", "rank", "doc_id", "score")
