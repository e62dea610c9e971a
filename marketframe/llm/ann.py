"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest ``prefix`` of ``pivots`` pivots, in order. In blocks of about ``block_rows`` vectors (dealt by hash) each pivot
has an inverted file: a dense row of its place in the order of every vector of the block, ``prefix`` where it is absent. A query reads the rows of its own pivots; from the places it
gets every vector's footrule distance, as shared pivots' displacements (a pivot that one side lacks counts as displaced to the end of the order). The ``rerank`` distinct vectors
of a block that are nearest by footrule, with all ties and all that are close to the query's own order, are ranked by the exact inner product, and the blocks' best ``k`` are merged.

The pivots come from a bounded sample; every vector is indexed. Queries are a stated set: they meet all blocks, in
blocks of ``query_rows``, so a task holds one block of each, whatever the tables' sizes. Equal vectors stand in a block's index once, with their ids, of which no
result needs more than the ``k + 1`` smallest; so a vector that a third of the rows hold doesn't crowd out others. As the rerank set is a share of
every block (an eighth by default), recall does not fall as the table grows.

Defined cases: vectors that are null, zero, hold null or non-finite components or have another length than most take no part, nor do null ids. Rows that share
an id count once (that of the smallest hash); a query's own id is no candidate for it. Ties go to smaller ids. With no more than ``k`` candidates all are returned. Extra columns
are ignored. Without valid vectors the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors within this share of the largest footrule are always ranked by their product: the members of a dense group.
CLOSE = 0.5
RESULT = "query_id long, vec_id long, score double"


def valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array of double) of the vectors that take part, one a distinct id."""
    v = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    sizes = whole.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    whole = whole.where(F.size("v") == (sizes[0].n if sizes else 0))
    return whole.groupBy("id").agg(F.min_by("v", F.struct(F.xxhash64("v"), F.col("v"))).alias("v"))


def pivot_sample(vectors: DataFrame, n: int, apart: float = 0.8, sample: int = 4096) -> np.ndarray:
    """At most n pivots: of the ``sample`` distinct vectors of the smallest hashes, in that order, those whose cosine with each
    pivot before is at most ``apart``. Pivots that stand together would tell a dense group's members apart no better than one."""
    keyed = vectors.select(F.xxhash64("v").alias("h"), "v")
    least = keyed.select("h").distinct().orderBy("h").limit(sample)
    rows = keyed.join(least, "h").groupBy("h").agg(F.min("v").alias("v")).orderBy("h").collect()
    chosen: list[np.ndarray] = []
    for r in rows:
        v = np.array(r.v, dtype=np.float64)
        v /= np.linalg.norm(v)
        if len(chosen) < n and (not chosen or (np.array(chosen) @ v).max() <= apart):
            chosen.append(v)
    return np.array(chosen)


def orders(v: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Places of the nearest pivots by angle, nearest first."""
    return np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """By pivot: every vector's place of it in its order, or ``prefix`` where it is absent. A block's vectors are few and the files of
    a quarter of the pivots or more hold each of them, so a file is a row of places without ids."""

    def __init__(self, order: np.ndarray, pivots: int):
        n, prefix = order.shape
        self.place = np.full((pivots, n), prefix, np.uint16)
        self.place[order.ravel(), np.repeat(np.arange(n), prefix)] = np.tile(np.arange(prefix), n)
        # what a shared pivot saves against one that either side lacks: both would count as moved to the end
        i = np.arange(prefix)
        self.saves = np.zeros((prefix, prefix + 1), np.int32)
        self.saves[:, :prefix] = (prefix - i)[:, None] + (prefix - i)[None, :] - np.abs(i[:, None] - i[None, :])
        self.most = int(prefix * (prefix + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        out = np.full(self.place.shape[1], self.most, np.int32)
        part = np.empty_like(out)
        for i, p in enumerate(order.tolist()):
            np.take(self.saves[i], self.place[p], out=part, mode="clip")
            out -= part
        return out


def _rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("id").to_numpy()
    return ids, t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def search_block(t: pa.Table, pivots: np.ndarray, prefix: int, rerank: int, k: int) -> pa.Table:
    """A block of vectors and a block of queries (column q tells) -> each query's best k of the block."""
    is_query = t.column("q").to_numpy(zero_copy_only=False).astype(bool)
    queries, base = t.filter(pa.array(is_query)), t.filter(pa.array(~is_query))
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not len(queries) or not len(base):
        return empty
    ids, v = _rows(base)
    by = np.argsort(ids, kind="stable")
    ids, v = ids[by], v[by]
    v, same = np.unique(v, axis=0, return_inverse=True)
    by = np.argsort(same.ravel(), kind="stable")
    cut = np.searchsorted(same.ravel()[by], np.arange(len(v) + 1))
    owners = [ids[by[a : min(b, a + k + 1)]] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    first = np.array([o[0] for o in owners])
    by = np.argsort(first, kind="stable")  # so that ties in footrule go to smaller ids
    v, owners = v[by], [owners[i] for i in by]
    files = InvertedFiles(orders(v, pivots, prefix), len(pivots))
    query_ids, q = _rows(queries)
    out: list[tuple[int, int, float]] = []
    for qid, vector, order in zip(query_ids.tolist(), q, orders(q, pivots, prefix), strict=True):
        near = files.footrule(order)
        bound = max(int(np.partition(near, rerank)[rerank]), int(CLOSE * files.most)) if len(near) > rerank else files.most
        few = np.flatnonzero(near <= bound)
        score = (v[few] * vector).sum(axis=1)  # row by row, so equal vectors get equal scores in every block
        found = []
        for j in np.argsort(-score, kind="stable").tolist():
            if len(found) >= k and score[j] < found[k - 1][0]:
                break
            found += [(float(score[j]), i) for i in owners[few[j]].tolist() if i != qid]
            found.sort(key=lambda x: (-x[0], x[1]))
            del found[k:]
        out += [(qid, i, s) for s, i in found]
    a, b, c = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})


def neighbours(rows: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, pivots: int = 256, prefix: int = 96, rerank: int = 512, block_rows: int = 4096, query_rows: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``is_query`` (a condition on the column ``id``)."""
    vectors = valid(rows, id_col, vector_col)
    n = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, query_blocks = max(1, -(-n.n // block_rows)), max(1, -(-n.q // query_rows))
    points = pivot_sample(vectors, pivots)
    bc = rows.sparkSession.sparkContext.broadcast(points)
    prefix = min(prefix, max(1, len(points) // 2))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    base = vectors.select("id", "v", F.lit(False).alias("q"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), every(query_blocks).alias("part"))
    queries = vectors.where(is_query).select("id", "v", F.lit(True).alias("q"), every(blocks).alias("block"), F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("part"))
    found = base.unionByName(queries).groupBy("block", "part").applyInArrow(lambda t: search_block(t, bc.value, prefix, rerank, k), RESULT)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
