import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def beside(tree, at):
    return [(lv[b], b > at >> k) if (b := (at >> k) ^ 1) < len(lv) else (None, None) for k, lv in enumerate(tree[:-1])]


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: h(*map(field, (r[0], r[3], r[2], n, r[1])))
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {g: levels([leaf(r, r[4]) for r in by[g]]) for g in order}
    crown = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(by[g]):
            path = beside(trees[g], at) + beside(crown, k)
            node = leaf(r, r[4] + 1 if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else r[4])
            for other, later in path:
                node = h(node) if other is None else h(node, other) if later else h(other, node)
            out.append((r[0], leaf(r, r[4]), trees[g][-1][0], crown[-1][0], h(*(o for o, _ in path if o)), node, node == crown[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tier", [1, 2, 3, 5])
def test_traversal_gives_every_path(tier):
    for n in [*range(1, 40), 64, 65, 127, 200]:
        leaves = [h(str(i)) for i in range(n)]
        for more in (0, 2):  # a block that ends early in a taller tree
            height = merkle.height_of(n) + more
            tree = levels(leaves)
            while len(tree) <= height:
                tree.append([h(tree[-1][0])])
            assert merkle.block_root(leaves, height) == tree[height][0]
            want = [("".join("-" if o is None else "r" if later else "l" for o, later in beside(tree, j)), [o for o, _ in beside(tree, j) if o]) for j in range(n)]
            assert list(merkle.Traversal(leaves, height, tier).paths()) == want


def test_traversal_keeps_little():
    walk = merkle.Traversal([h(str(i)) for i in range(1024)], 10)
    for _ in walk.paths():
        held = sum(len(x) for tier in walk.existing for x in tier) + sum(len(x) for g in walk.desired for x in g.kept) + sum(len(g.stack) for g in walk.desired)
        assert held <= 2 * (2 ** (merkle.TIER + 1)) * 4 + 10 * 4


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"text {i} ü", ["en", "de", "fr", None][min(i % 5, 3)] if i % 11 else "en", f"s{i % 3}", i * 7 if i % 4 else None) for i in range(230)]
    return [*out, (7, "again", "zz", None, 1), (3, "text 3 ü", None, "s0", 21), (3, "text 3 ü", None, "s0", 21), (None, None, None, None, None), (None, "", "", "", 0), (9, "x" * 200_000, "é", "s", 2**63 - 1), (5, "", "", "s", 4)]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equal_to_brute_force(spark, rows, height):
    """Blocks of two and four leaves make several levels of blocks, of rows and of groups."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = queries.merkle_rows(docs, height).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert {r.verified for r in got} == {True, False}


def test_one_row_no_row_and_clashing_names(spark):
    one = spark.createDataFrame([(1, "t", "en", "v", 1)], "doc_id long, text string, lang string, leaf string, root int")
    got = merkle.manifest(one, merkle.leaf_of(F.col("doc_id"), F.col("text"))).collect()
    assert [(r.leaf, r.subroot, r.root, r.sides, r.siblings) for r in got] == [(h("1:1", "1:t"),) * 3 + ("", [])]
    none = merkle.manifest(one.limit(0), merkle.leaf_of(F.col("doc_id")))
    assert none.count() == 0 and none.columns == ["doc_id", "lang", "leaf", "subroot", "root", "sides", "siblings"]


def test_proofs_hold_and_tampered_leaves_fail(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs, merkle.leaf_of(*map(F.col, docs.columns)), carry={"wrong": F.sha2(F.lit("x"), 256)})
    ok = merkle.folded(F.col("leaf"), F.col("sides"), F.col("siblings")) == F.col("root")
    bad = merkle.folded(F.col("wrong"), F.col("sides"), F.col("siblings")) == F.col("root")
    assert [tuple(r) for r in found.select(ok, bad).distinct().collect()] == [(True, False)]
