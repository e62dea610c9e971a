"""Merkle manifest of a dataset: one tree per group in a postorder append log, proofs read from the log by position.

A leaf is the SHA-256 of a row's fields. Per group, leaves ascend by id; every ``ARITY`` consecutive nodes (the last run: fewer, even
one) become the digest of their digests' text, level by level, until one node remains, the group's subroot. The subroots, ordered by
group, are the leaves of the tree of the root.

Layout. Rows are dealt by ranges of (group, id) and numbered from the counts of the ranges, so no group is ever one task's work. An
aligned builder takes ``ARITY ** LEVELS`` leaves of one group and appends nodes in the order in which they are complete: a node follows its last
child. What it has written is one segment of the log; its last node, the head, is a leaf of the next tier. Tiers end when each group has one
node. Nothing in the log points anywhere: a node is found by arithmetic. Before leaf i, ``i + i // 8 + i // 64 + ...`` nodes are complete, and
a node of level k stands k places after its last leaf (``position``). Proofs are read tier by tier from the top: a segment meets the proof of its head, and each of its leaves adds the siblings
at their positions. A segment, its leaves and a proof are of bounded size.

Defined cases: null fields have a mark of their own, so null and empty differ; null ids stand first in their group, rows of one id ascend by their
leaf; null is a group of its own and the first one; an empty table has an empty log and no root. Repeated rows are leaves of their own. Texts are hashed whole. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.llm.components import written

ARITY = 8
LEVELS = 3
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PROOF = "array<struct<left:string,right:string>>"
SEGMENT = "tree string, tier int, block long, of long, size long, nodes binary, head string"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def position(level: int, index: int, n: int) -> int:
    """Place in the log of the ``index``-th node of a level, in a tree of n leaves."""
    last = min((index + 1) * ARITY**level, n) - 1
    place, left = level, last
    while left:
        place, left = place + left, left // ARITY
    return place


def append_nodes(leaves: Sequence[str], levels: int) -> list[str]:
    """The nodes over the leaves up to a level, in the order in which they are complete."""
    out: list[str] = []
    open_: list[list[str]] = [[] for _ in range(levels + 1)]

    def put(level: int, node: str) -> None:
        out.append(node)
        open_[level].append(node)
        if len(open_[level]) == ARITY and level < levels:
            close(level)

    def close(level: int) -> None:
        node = digest(open_[level])
        open_[level].clear()
        put(level + 1, node)

    for leaf in leaves:
        put(0, leaf)
    for level in range(levels):  # the last run of each level may be shorter
        if open_[level]:
            close(level)
    return out


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``at``, the number of the row in its ``tree`` by ``order``, and ``n``, the tree's rows. The ranges are written first, so that
    their numbers hold whatever is computed again."""
    key = [F.col(c).asc_nulls_first() for c in order]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id())  # so equal rows can be in several ranges
    dealt = written(dealt.repartitionByRange("tree", *key, "tie").sortWithinPartitions("tree", *key, "tie").withColumn("part", F.spark_partition_id()), name)
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    # a row a range and tree: ranges and trees in all
    before = counts.select("tree", "part", *[F.expr(f"coalesce(sum(rows) over (partition by tree {o}), 0)").alias(c) for c, o in (("before", "order by part rows between unbounded preceding and 1 preceding"), ("n", ""))])
    within = F.expr(f"row_number() over (partition by tree, part order by {', '.join(c + ' nulls first' for c in order)}, tie)")
    return dealt.withColumn("within", within).join(before, ["tree", "part"]).withColumn("at", F.col("before") + F.col("within") - 1).drop("within", "before", "part", "tie")


def _segments(leaves: DataFrame, tier: int) -> DataFrame:
    """The builders of a tier: a segment for each block of ``leaves`` (tree, at, n, digest)."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        tree, n, block = (table.column(c)[0].as_py() for c in ("tree", "n", "block"))
        of = -(-n // BLOCK)
        nodes = append_nodes(table.column("digest").to_pylist(), LEVELS if of > 1 else height(n))
        row = (tree, tier, block, of, table.num_rows, b"".join(map(bytes.fromhex, nodes)), nodes[-1])
        return pa.table([pa.array([v], f.type) for v, f in zip(row, _SEGMENT, strict=True)], schema=_SEGMENT)

    blocks = leaves.select("tree", "at", "n", "digest", F.expr(f"at div {BLOCK}").alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(build, SEGMENT)


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """Segments of every tier, written."""
    tiers: list[DataFrame] = []
    while True:
        tiers.append(written(_segments(leaves, len(tiers)), "log"))
        more = tiers[-1].where("of > 1")
        if more.isEmpty():
            return tiers
        leaves = more.select("tree", F.col("block").alias("at"), F.col("of").alias("n"), F.col("head").alias("digest"))


def _extract(leaves: DataFrame, segments: DataFrame, keep: Sequence[T.StructField] = ()) -> DataFrame:
    """``subroot`` and ``proof`` of each leaf (tree, at and the columns of ``keep``) from its segment, which has those of its head."""
    names = ["tree", "at", *[f.name for f in keep]]
    out = T.StructType([T.StructField("tree", T.StringType()), T.StructField("at", T.LongType()), *keep, T.StructField("subroot", T.StringType()), T.StructField("proof", T._parse_datatype_string(PROOF))])

    def prove(rows: pa.Table, segment: pa.Table) -> pa.Table:
        at = rows.column("at").to_pylist()
        nodes, of, block, size, subroot, above = (segment.column(c)[0].as_py() for c in ("nodes", "of", "block", "size", "subroot", "above"))
        known: dict[tuple[int, int], dict[str, str]] = {}

        def node(level: int, index: int) -> str:
            p = 32 * position(level, index, size)
            return nodes[p : p + 32].hex()

        def siblings(level: int, index: int) -> dict[str, str]:
            if (level, index) not in known:
                first = index - index % ARITY
                run = [node(level, i) for i in range(first, min(first + ARITY, -(-size // ARITY**level)))]
                for i in range(len(run)):
                    known[level, first + i] = {"left": "".join(run[:i]), "right": "".join(run[i + 1 :])}
            return known[level, index]

        levels = LEVELS if of > 1 else height(size)
        proofs = [[siblings(k, (a - block * BLOCK) // ARITY**k) for k in range(levels)] + above for a in at]
        return pa.table([*[rows.column(c) for c in names], pa.array([subroot] * len(at), pa.string()), pa.array(proofs, _PROOF)], names=out.names)

    blocks = leaves.select(*names, F.expr(f"at div {BLOCK}").alias("block"))
    return blocks.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(prove, out)


def _headed(tiers: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest tier's segments with ``subroot`` and the proof ``above`` of their heads; ``tops`` has them for each tree."""
    last = tiers[0].where("of = 1").join(tops, "tree")  # one segment a tree
    if len(tiers) == 1:
        return last
    heads = _extract(tiers[0].where("of > 1").select("tree", F.col("block").alias("at")), _headed(tiers[1:], tops))
    return last.unionByName(tiers[0].where("of > 1").join(heads.select("tree", F.col("at").alias("block"), "subroot", F.col("proof").alias("above")), ["tree", "block"]))


@dataclass
class Manifest:
    """``leaves`` (tree, at, n, digest and what was carried), the log's segments by tier of the groups' trees and of the root's, whose leaves are
    ``subroots`` (name of the group's tree), and the root (None: no rows)."""

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    tops: list[DataFrame]
    root: str | None


def tree_of(group: Column) -> Column:
    """Name of a group's tree: null first, then by the bytes of its UTF-8."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def build(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS, carry: dict[str, Column] | None = None) -> Manifest:
    """Writes the append log of ``docs``; the columns of ``carry`` stay with the leaves."""
    carry = carry or {}
    rows = docs.select(tree_of(F.col(group_col)).alias("tree"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("digest"), *[c.alias(k) for k, c in carry.items()])
    leaves = written(numbered(rows, ["id", "digest"], "leaves"), "leaves")
    tiers = _tiers(leaves)
    heads = reduce(DataFrame.unionByName, [t.where("of = 1") for t in tiers])
    subroots = written(numbered(heads.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("head").alias("digest")), ["name"], "subroots"), "subroots")
    tops = _tiers(subroots)
    root = tops[-1].select("head").first()
    return Manifest(leaves, tiers, subroots, tops, root and root[0])


def proofs(m: Manifest) -> DataFrame:
    """Every leaf with its ``subroot`` and its ``proof``: for each level, from the leaf's up to the root's, its siblings' digests, ``left`` and ``right`` of it."""
    none = F.from_json(F.lit("[]"), PROOF)
    roots = m.tops[-1].select("tree", F.col("head").alias("subroot"), none.alias("above"))
    tops = _extract(m.subroots.select("tree", "at", "name"), _headed(m.tops, roots), [m.subroots.schema["name"]])
    ends = m.subroots.join(tops.select("name", "proof"), "name").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("above"))
    keep = [f for f in m.leaves.schema if f.name not in ("tree", "at", "n")]
    return _extract(m.leaves.drop("n"), _headed(m.tiers, ends), keep).drop("at")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def siblings(proof: Column) -> Column:
    """The digests of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def log(m: Manifest) -> DataFrame:
    """The groups' trees as one append log: tree, position, level, index and digest of each node."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["tree", "tier", "block", "of", "size", "nodes", "n"]).to_pylist():
                rows = []
                for level in range(LEVELS + 1 if row["of"] > 1 else height(row["size"]) + 1):
                    for i in range(-(-row["size"] // ARITY**level) if level or not row["tier"] else 0):  # a tier's leaves are nodes of the tier below
                        p = 32 * position(level, i, row["size"])
                        k, index = level + LEVELS * row["tier"], row["block"] * ARITY ** (LEVELS - level) + i
                        rows.append((row["tree"], position(k, index, row["n"]), k, index, row["nodes"][p : p + 32].hex()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LOG, strict=True)], schema=_LOG)

    sizes = m.leaves.groupBy("tree").agg(F.max("n").alias("n"))
    return reduce(DataFrame.unionByName, m.tiers).join(sizes, "tree").mapInArrow(nodes, "tree string, position long, level int, index long, digest string")


_PROOF = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_SEGMENT = pa.schema([("tree", pa.string()), ("tier", pa.int32()), ("block", pa.int64()), ("of", pa.int64()), ("size", pa.int64()), ("nodes", pa.binary()), ("head", pa.string())])
_LOG = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string())])
