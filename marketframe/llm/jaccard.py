"""N-gram Jaccard join: documents whose sets of word n-grams are at least a given share alike, and their groups.

Documents with equal sets are one node from the start. A set's n-grams are put in one global order, rare ones first, and two sets that are alike
enough share an n-gram of their prefixes (the first ``size - ceil(t * size) + 1``). The prefix n-grams are dealt out by n-gram;
a length filter, a positional filter and a suffix filter (differences of histograms of the n-grams, a lower bound of the distance: eight
counts on each post, then 64 per set on each distinct pair) prune pairs; what is left is verified once per pair on the whole sets.

Groups instead of all pairs: a first round pairs the nodes of an n-gram with that of the earliest position only (in a group of near copies,
the one nearest to their origin), which finds nearly all groups with as many pairs as prefix entries. A second round makes every pair that passes the
filters between nodes that the first left in different components; pairs within a component can add nothing. So no link between different
texts is lost, and a group of thousands of near copies makes no square of pairs.

Rarity comes from a sketch of fixed size (document frequencies by 2**20 buckets of hashes, summed over all documents): any one
order gives the same result, the frequent n-grams are told apart, and what is broadcast does not grow. Posts are 44 bytes a row; sets are
shuffled only for nodes that have a candidate. A rare-n-gram's posts, without their sets, are one task's work at a time.

Defined cases: a null text, or one without words, has no set and is linked with nothing; its component is its own id. A text with fewer than n words has its whole sequence as the one n-gram. Repeated rows have equal
sets. Null ids take part in links; a component's id is its smallest non-null id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.components import components, written
from marketframe.llm.words import Words, mix, pieces, rolling

BUCKETS = 1 << 20
SLICES = 16
BITS = 1 << 24
SMALL = 16
SIG = 64


def ngram_sets(w: Words, n: int) -> Iterator[np.ndarray]:
    """The sorted set of each text's n-gram hashes; empty without words."""
    grams = w.grams(n)
    for a, b in zip(w.doc[:-1].tolist(), w.doc[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        else:
            yield mix(rolling(w.hash[a:b], b - a) ^ np.uint64(b - a)) if b > a else grams[:0]


def node_of(s: np.ndarray) -> bytes | None:
    """128 bits that stand for a set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def at_least(size, num: int, den: int):
    """ceil(size * num / den)"""
    return -(-size * num // den)


def sizes_and_nodes(docs: DataFrame, n: int, kind: str) -> DataFrame:
    """``id, key, size, node, sig`` (histogram of the set) of docs (id, key, text)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node, sig = [], [], []
            for _, w in pieces(batch.column("text"), kind):
                for s in ngram_sets(w, n):
                    size.append(len(s))
                    node.append(node_of(s))
                    sig.append((np.bincount((s & np.uint64(SIG - 1)).astype(np.int64), minlength=SIG) % 256).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(size, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())], names=["id", "key", "size", "node", "sig"])

    return docs.mapInArrow(step, f"id {docs.schema['id'].dataType.simpleString()}, key string, size bigint, node binary, sig binary")


def frequency_sketch(docs: DataFrame, n: int, kind: str) -> np.ndarray:
    """Document frequencies of n-grams by the first 20 bits of their hashes."""
    part = BUCKETS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, w in pieces(batch.column("text"), kind):
                sets = list(ngram_sets(w, n))
                if sets:
                    total += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(SLICES), pa.int32()), "counts": pa.array([total[i * part : (i + 1) * part].tobytes() for i in range(SLICES)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.part * part : (r.part + 1) * part] = np.frombuffer(r.counts, np.int64)
    return out


POST = pa.schema([("token", pa.int64()), ("node", pa.binary()), ("size", pa.int32()), ("pos", pa.int32()), ("hist", pa.int64())])
POST_DDL = "token bigint, node binary, size int, pos int, hist bigint"


def _histogram(s: np.ndarray) -> int:
    """Eight counts of n-grams, each modulo 256."""
    return int.from_bytes((np.bincount((s & np.uint64(7)).astype(np.int64), minlength=8) % 256).astype(np.uint8).tobytes(), "little", signed=True)


def prefix_posts(docs: DataFrame, frequencies, n: int, kind: str, num: int, den: int) -> DataFrame:
    """The prefix n-grams of each set; of equal sets, one per task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = frequencies.value, set()
        for batch in batches:
            for _, w in pieces(batch.column("text"), kind):
                tokens, nodes, sizes, hists, counts = [], [], [], [], []
                for s in ngram_sets(w, n):
                    node = node_of(s)
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    p = len(s) - at_least(len(s), num, den) + 1
                    f = often[(s >> np.uint64(44)).astype(np.int64)]
                    if p < len(s):
                        few = np.flatnonzero(f <= np.partition(f, p - 1)[p - 1])
                        few = few[np.argsort(f[few], kind="stable")[:p]]
                    else:
                        few = np.argsort(f, kind="stable")
                    tokens.append(s[few])
                    nodes.append(node)
                    sizes.append(len(s))
                    hists.append(_histogram(s))
                    counts.append(len(few))
                if tokens:
                    owner = np.repeat(np.arange(len(nodes)), counts)
                    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(tokens).view(np.int64)), pa.array(nodes, pa.binary()).take(pa.array(owner)), pa.array(np.array(sizes, np.int32)[owner]),
                        pa.array(place.astype(np.int32)), pa.array(np.array(hists, np.int64)[owner]),
                    ], schema=POST)

    return docs.select("text").mapInArrow(step, POST_DDL)


def _whole_groups(batches: Iterator[pa.RecordBatch], at_least_rows: int = 200_000) -> Iterator[pa.Table]:
    """Tables that end where a token ends, from batches in order of token."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows += batch.num_rows
        t = batch.column("token").to_numpy()
        if rows < at_least_rows or t[0] == t[-1]:
            continue
        cut = int(np.searchsorted(t, t[-1], "left"))
        yield pa.Table.from_batches([*kept[:-1], batch.slice(0, cut)])
        kept, rows = [batch.slice(cut)], batch.num_rows - cut
    if kept:
        yield pa.Table.from_batches(kept)


def stars(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Posts of n-grams that several nodes have, with the node of the earliest position: ``lead, lead_size, lead_pos, lead_hist``; and
    ``again``: whether the post may link to another than the lead (known for small groups, taken for granted in others)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            t = t.combine_chunks()
            token = t.column("token").to_numpy()
            node = t.column("node").combine_chunks()
            first = np.concatenate([[True], token[1:] != token[:-1]])
            # equal sets from several tasks stand together
            words = np.frombuffer(node.buffers()[2], np.uint64, 2 * len(node), node.offset * 16).reshape(-1, 2)
            again = np.concatenate([[False], (words[1:] == words[:-1]).all(1)]) & ~first
            t, first = t.filter(pa.array(~again)), first[~again]
            start = np.flatnonzero(first)
            count = np.diff(np.append(start, len(first)))
            several = np.repeat(count > 1, count)
            lead = np.repeat(start, count)
            out = t.filter(pa.array(several))
            head = t.take(pa.array(lead[several]))
            for c in ("node", "size", "pos", "hist"):
                out = out.append_column(f"lead_{c}", head.column(c))
            out = out.append_column("again", pa.array(_again(out, num, den)))
            yield from out.rename_columns([*POST.names, "lead", "lead_size", "lead_pos", "lead_hist", "again"]).to_batches(max_chunksize=50_000)

    # a node's posts have one size and one position a token: copies of a node are neighbours in this order
    dealt = posts.repartition("token").sortWithinPartitions("token", "pos", "size", "node")
    return dealt.mapInArrow(step, POST_DDL + ", lead binary, lead_size int, lead_pos int, lead_hist bigint, again boolean")


def _again(t: pa.Table, num: int, den: int) -> np.ndarray:
    """Rows of a table of whole groups, leads first, that pass the filters with a row other than their lead."""
    token, size, pos, hist = (t.column(c).to_numpy().astype(np.int64) for c in ("token", "size", "pos", "hist"))
    if not len(token):
        return np.zeros(0, bool)
    first = np.concatenate([[True], token[1:] != token[:-1]])
    count = np.diff(np.append(np.flatnonzero(first), len(token)))
    out = np.repeat(count > SMALL, count)
    for d in range(1, min(SMALL, len(token))):
        # a pair may be left out only if both ends are marked: a marked row still has to mark its partners
        i = np.flatnonzero((token[:-d] == token[d:]) & ~first[:-d] & ~(out[:-d] & out[d:]))
        i = i[may_link(size[i], pos[i], hist[i], size[i + d], pos[i + d], hist[i + d], num, den)]
        out[i] = out[i + d] = True
    return out


def may_link(nx, px, hx, ny, py, hy, num: int, den: int):
    """Length, positional and suffix filter, on arrays."""
    need = at_least((nx + ny), num, num + den)
    ok = (np.minimum(nx, ny) * den >= np.maximum(nx, ny) * num) & (np.minimum(nx - px, ny - py) >= need)
    apart = np.zeros(np.shape(ok), np.int64)
    for i in range(0, 64, 8):
        d = ((hx >> i) & 255) - ((hy >> i) & 255)
        d = np.abs(d)
        apart = apart + np.minimum(d, 256 - d)
    return ok & (apart <= nx + ny - 2 * need)


def star_pairs(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (x < y) of nodes with their n-gram's lead, after the filters."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {k: b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("size", "pos", "hist", "lead_size", "lead_pos", "lead_hist")}
            ok = may_link(c["size"], c["pos"], c["hist"], c["lead_size"], c["lead_pos"], c["lead_hist"], num, den)
            b = b.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("lead")], names=["x", "y"])

    return _ordered(posts.mapInArrow(step, "x binary, y binary"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def open_pairs(posts: DataFrame, roots: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs of nodes that share a prefix n-gram, pass the filters and stand in different components."""
    rooted = posts.where("again").select(*POST.names).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            node = t.column("node").combine_chunks()
            names, root = np.unique(np.array(t.column("root").to_pylist(), dtype=object), return_inverse=True)
            c = {k: t.column(k).to_numpy().astype(np.int64) for k in ("token", "size", "pos", "hist")}
            xs, ys = [], []
            for i, j in _crossing(c["token"], c["size"], c["pos"], root):
                ok = may_link(c["size"][i], c["pos"][i], c["hist"][i], c["size"][j], c["pos"][j], c["hist"][j], num, den)
                xs.append(i[ok])
                ys.append(j[ok])
            if xs:
                yield pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(xs))), node.take(pa.array(np.concatenate(ys)))], names=["x", "y"])

    def _crossing(token, size, pos, root) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs of one token and different roots, of sizes that can go with each other; rows are in order of token and size."""
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(start, len(token)))
        small = np.repeat(count <= SMALL, count)
        for d in range(1, SMALL):
            i = np.flatnonzero(small[:-d] & (token[:-d] == token[d:]) & (root[:-d] != root[d:])) if len(token) > d else np.zeros(0, np.int64)
            if len(i):
                yield i, i + d
        for a, m in zip(start[count > SMALL].tolist(), count[count > SMALL].tolist(), strict=True):
            r, s = root[a : a + m], size[a : a + m]
            big = np.bincount(r).argmax()
            rest = np.flatnonzero(r != big)
            # sizes a row can go with: not too small, and at most what its position leaves
            least = at_least(s[rest], num, den)
            most = np.minimum(s[rest] * den // num, (s[rest] - pos[a + rest]) * (num + den) // num - s[rest])
            lo, hi = np.searchsorted(s, least, "left"), np.searchsorted(s, most, "right")
            for k, u, v in zip(rest.tolist(), lo.tolist(), hi.tolist(), strict=True):
                j = u + np.flatnonzero(r[u:v] != r[k])
                j = j[(r[j] == big) | (j > k)]  # two rows of the rest meet from both sides
                if len(j):
                    yield np.full(len(j), a + k), a + j

    return _ordered(rooted.repartition("token").sortWithinPartitions("token", "size", "node").mapInArrow(step, "x binary, y binary"))


def likely(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The docs whose key is in ``keys``, and few others: a bitmap of fixed size, of key hashes, is broadcast. It spares the texts that
    aren't asked for the shuffle of the exact join that follows; with very many keys it fills up and spares none."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            bits[batch.column("bit").to_numpy()] = True
        packed, size = np.packbits(bits), BITS // 8 // SLICES
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(SLICES), pa.int32()), "bits": pa.array([packed[i * size : (i + 1) * size].tobytes() for i in range(SLICES)], pa.binary())})

    def either(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([np.frombuffer(c, np.uint8) for c in table.column("bits").to_pylist()])
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([total.tobytes()], pa.binary())})

    bit = F.pmod(F.xxhash64("key"), F.lit(BITS)).alias("bit")
    rows = keys.select(bit).mapInArrow(mark, "part int, bits binary").groupBy("part").applyInArrow(either, "part int, bits binary").collect()
    packed = docs.sparkSession.sparkContext.broadcast(b"".join(r.bits for r in sorted(rows, key=lambda r: r.part)) or bytes(BITS // 8))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(packed.value, np.uint8)
        for batch in batches:
            at = batch.column("bit").to_numpy()
            yield batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)).select(["key", "text"])

    return docs.select("key", "text", bit).mapInArrow(step, "key string, text string")


def plausible(pairs: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that pass the suffix filter on whole histograms (known: node, size, sig)."""
    side = lambda c: known.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sx, sy = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SIG).astype(np.int16) for c in ("sx", "sy"))
            nx, ny = b.column("nx").to_numpy(), b.column("ny").to_numpy()
            d = np.abs(sx - sy)
            ok = np.minimum(d, 256 - d).sum(axis=1) <= nx + ny - 2 * at_least(nx + ny, num, num + den)
            yield b.filter(pa.array(ok)).select(["x", "y"])

    return pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(step, "x binary, y binary")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, kind: str, num: int, den: int) -> DataFrame:
    """The pairs whose sets are alike enough. Texts are read again for nodes that stand in a pair."""
    asked = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
    known = written(nodes.join(asked, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"), F.first("size").alias("size"), F.first("sig").alias("sig")), "asked")
    pairs = written(plausible(pairs, known, num, den), "pairs")
    asked = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
    keys = written(known.join(asked, "node", "left_semi").select("key"), "keys")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, w in pieces(batch.column("text"), kind):
                node, sets = [], []
                for s in ngram_sets(w, n):
                    k = node_of(s)
                    if k is not None and k not in seen:
                        seen.add(k)
                        node.append(k)
                        sets.append(s.view(np.int64))
                if node:
                    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(sets)))], names=["node", "grams"])

    sets = likely(docs, keys).join(keys, "key", "left_semi").select("text").mapInArrow(step, "node binary, grams array<bigint>")
    sets = sets.groupBy("node").agg(F.first("grams").alias("grams"))
    one = pairs.join(sets.select(F.col("node").alias("x"), F.col("grams").alias("gx")), "x")
    two = one.join(sets.select(F.col("node").alias("y"), F.col("grams").alias("gy")), "y")
    both = F.size(F.array_intersect("gx", "gy"))
    return two.where(both * den >= (F.size("gx") + F.size("gy") - both) * num).select("x", "y")


def grouped(docs: DataFrame, *, id_col: str, text_col: str, n: int, threshold: tuple[int, int], kind: str) -> DataFrame:
    """``id, key`` (md5 of the text), ``size, node`` and ``root`` (null without words) of every document."""
    num, den = threshold
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.md5(F.col(f"`{text_col}`")).alias("key"), F.col(f"`{text_col}`").alias("text"))
    nodes = written(sizes_and_nodes(rows, n, kind), "nodes")
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(rows, n, kind))
    posts = written(stars(prefix_posts(rows, sketch, n, kind, num, den), num, den), "posts")
    tried = written(star_pairs(posts, num, den), "pairs")
    links = written(verified(tried, rows, nodes, n, kind, num, den), "links")
    roots = components(links)
    more = written(open_pairs(posts, roots, num, den).join(tried, ["x", "y"], "left_anti"), "pairs")
    if not more.isEmpty():
        new = written(verified(more, rows, nodes, n, kind, num, den), "links")
        if not new.isEmpty():
            roots = components(links.union(new))
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: tuple[int, int] = (90, 100), kind: str = "space_lower") -> DataFrame:
    """Per document: id, n_shingles (size of its set) and component_id (smallest id reachable by links). The links themselves
    are those of ``verified``."""
    found = grouped(docs, id_col=id_col, text_col=text_col, n=n, threshold=threshold, kind=kind)
    # a table of its own, so that the join below can split a hot group
    least = written(found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("least")), "least")
    return found.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: tuple[int, int] = (80, 100), kind: str = "space_lower") -> DataFrame:
    """The rows of ``docs``, of each group only the one of the smallest id (null last; then the smallest text hash; of equal ids and texts the
    smallest other columns). Rows without words all stay."""
    found = grouped(docs, id_col=id_col, text_col=text_col, n=n, threshold=threshold, kind=kind)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("f")
    chosen = found.where(F.col("root").isNotNull()).groupBy("root").agg(first).select(F.col("f.id").alias("i"), F.col("f.key").alias("k"))
    empty = found.where(F.col("root").isNull()).select(F.col("id").alias("i"), F.col("key").alias("k")).distinct()
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.md5(F.col(f"`{text_col}`")).alias("key"))
    match = lambda t: F.col("key").eqNullSafe(t.k) & F.col("id").eqNullSafe(t.i)
    one = rows.join(chosen, match(chosen), "left_semi").groupBy("key", "id").agg(F.min("row").alias("row"), F.first("text").alias("text"))
    out = one.select("row", "text").union(rows.join(empty, match(empty), "left_semi").select("row", "text"))
    return out.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in names])
