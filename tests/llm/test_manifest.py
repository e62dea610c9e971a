"""The manifest against a sequential one, and its log against a sequential builder."""

import hashlib
import zlib

from pyspark.sql import functions as F

from marketframe.llm import manifest
from marketframe.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.data import documents, folded, prose


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def up(nodes):
    """Levels of a tree, from its leaves to its one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    """(index in the run, the run) from a leaf up."""
    out = []
    for nodes in levels[:-1]:
        out.append((i % 8, nodes[i - i % 8 : i - i % 8 + 8]))
        i //= 8
    return out


def sequential(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: up([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = up([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_, _, digest, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = way(trees[g], i) + way(top, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf((*r[:4], folded(r[4]) if r[4] is not None else None)) if changed else digest
            proof = ""
            for j, run in steps:
                proof += "".join(run[:j] + run[j + 1 :])
                node = h(*run[:j], node, *run[j + 1 :])
            out.append((r[0], digest, trees[g][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return out


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def write(spark, rows, path):
    clash = ("tree", "at", "n", "id", "digest", "part", "tie", "block", "proof")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit(f"own {c}") for c in clash})
    docs.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_manifest_of_awkward_rows(spark, tmp_path):
    rows = [(i, s, ["en", "de", None, "", "é", "z"][k % 6], None if k % 5 == 0 else len(t or ""), t) for k, (i, t, s) in enumerate(documents())]
    rows += [rows[3]] * 3 + [(7, None, None, None, None), (7, "", "", 0, ""), (None, None, "only", None, "Alone")]
    got = QUERIES["op12_merkle_manifest"](spark, write(spark, rows, tmp_path / "a")).collect()
    want = sequential(rows)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(w[6] for w in want) and any(not w[6] for w in want)


def test_manifest_of_many_tiers(spark, tmp_path):
    sizes = {None: 1, "a": 8, "b": 9, "c": 64, "d": 512, "e": 513, "f": 4200, **{f"g{i}": 2 for i in range(600)}}
    rows = [(n * 5000 + i, "s", g, i, prose(i, 3)) for n, (g, k) in enumerate(sizes.items()) for i in range(k)]
    got = QUERIES["op12_merkle_manifest"](spark, write(spark, rows, tmp_path / "b")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(sequential(rows), key=repr)


def test_log_is_in_order_of_completion(spark, tmp_path):
    sizes = {"a": 1, "b": 20, "c": 513, "d": 1100}
    rows = [(i, "s", g, 0, f"{g}{i}") for g, k in sizes.items() for i in range(k)]
    made = manifest.build(spark.read.parquet(write(spark, rows, tmp_path / "c") + "/documents.parquet"))
    log = manifest.log(made).collect()
    for g, k in sizes.items():
        leaves = [leaf(r) for r in rows if r[2] == g]
        assert [r.digest for r in sorted(log, key=lambda r: r.position) if r.tree == "=" + g] == manifest.append_nodes(leaves, manifest.height(k))
        levels = up(leaves)
        assert all(r.digest == levels[r["level"]][r["index"]] for r in log if r.tree == "=" + g)
    assert len(log) == sum(len(x) for g in sizes for x in up([leaf(r) for r in rows if r[2] == g]))


def test_positions_number_every_node():
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512, 513, 1000):
        counts = [-(-n // 8**k) for k in range(manifest.height(n) + 1)]
        assert sorted(manifest.position(k, i, n) for k, c in enumerate(counts) for i in range(c)) == list(range(sum(counts)))


def test_empty_and_single(spark, tmp_path):
    assert QUERIES["op12_merkle_manifest"](spark, write(spark, [], tmp_path / "d")).count() == 0
    one = [(5, None, None, None, "Text")]
    assert [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, write(spark, one, tmp_path / "e")).collect()] == sequential(one)


def test_manifest_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = QUERIES["op12_merkle_manifest"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(sequential(rows), key=repr)
