"""The manifest against its SQL and against a plain tree, over many blocks and odd rows."""

import hashlib
import zlib

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from feedloom.llm import merkle as M

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """(root, [(left, right) by level] of each leaf) by rebuilding every level."""
    proofs, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, n in enumerate(at):
            run = n // 3 * 3
            proofs[i].append(("".join(nodes[run:n]), "".join(nodes[n + 1 : run + 3])))
        at = [n // 3 for n in at]
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def plain_manifest(rows):
    """[(key, leaf, subroot, root, proof)] of rows (group, key, leaf)."""
    groups = {}
    for g, k, leaf in rows:
        groups.setdefault(g, []).append((k is not None, k or 0, leaf, k))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        for r, proof in zip(sorted(groups[g], key=lambda r: r[:3]), trees[g][1], strict=True):
            out.append((r[3], r[2], trees[g][0], root, tuple(proof + up)))
    return sorted(out, key=str)


def made(spark, rows, depth):
    leaves = spark.createDataFrame(rows, "grp string, id bigint, leaf string")
    got = M.manifest(leaves, "grp", "id", "leaf", depth=depth).collect()
    return sorted(((r.id, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in got), key=str)


def test_documents_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op11", M.manifest_of_documents, M.ORACLE, SF)
    assert problem is None, problem


# sizes at, under and over full subtrees, so that last subtrees have fewer blocks than their siblings
@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, "b": 4, None: 1}, {"a": 59, "é": 9, "Z": 10, "": 28, None: 2}])
@pytest.mark.parametrize("depth", [1, 6])
def test_blocks_equal_the_plain_tree(spark, sizes, depth):
    rows = [(g, i * 7 % 101, h(str(g), str(i))) for g, n in sizes.items() for i in range(n)]
    assert made(spark, rows, depth) == plain_manifest(rows)


def test_many_groups_make_a_tree_of_blocks(spark):
    rows = [(f"g{i}", i, h(str(i))) for i in range(31)] + [("g5", 900 + i, h("x", str(i))) for i in range(13)]
    assert made(spark, rows, 1) == plain_manifest(rows)


def test_null_keys_ties_and_repeated_rows(spark):
    rows = [("a", None, h("n")), ("a", None, h("m")), (None, 3, h("t")), ("a", 3, h("u")), ("a", 3, h("b"))]
    rows += [("a", 4, h("same"))] * 12
    assert made(spark, rows, 1) == plain_manifest(rows)


def test_a_proof_fails_for_another_leaf(spark):
    rows = [("a", i, h(str(i))) for i in range(11)] + [("b", i, h("b", str(i))) for i in range(4)]
    leaves = spark.createDataFrame(rows, "grp string, id bigint, leaf string")
    got = M.manifest(leaves, "grp", "id", "leaf", depth=1)
    checked = got.select(
        "root",
        M.folded(F.col("leaf"), F.col("proof")).alias("good"),
        M.folded(F.sha2(F.col("leaf"), 256), F.col("proof")).alias("bad"),
    ).collect()
    assert all(r.good == r.root != r.bad for r in checked)


def write(spark, tmp_path, rows):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, root string, leaf int, _group int"
    spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    return M.manifest_of_documents(spark, str(tmp_path))


def test_query_on_odd_rows(spark, tmp_path):
    rows = [
        (1, "a", "en", 3, "a\nb"),
        (2, "a", None, None, None),
        (3, None, "é", 0, ""),
        (4, "a", "en", 9, "no line end"),
        (None, "a", "en", 1, "x\ny"),
        (5, "b", "en", 1, "é\n" * 300_000),
        (5, "b", "en", 1, "é\n" * 300_000),
    ]
    got = {(r.doc_id, r.leaf): r for r in write(spark, tmp_path, rows).collect()}
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = plain_manifest([(r[1], r[0], h(*map(field, (r[0], r[1], r[2], r[3], r[4])))) for r in rows])
    assert set(got) == {w[:2] for w in want}
    texts = {h(*map(field, r)): r for r in rows}
    for key, leaf, subroot, root, proof in want:
        r = got[key, leaf]
        assert (r.subroot, r.root) == (subroot, root)
        doc = texts[leaf]
        touched = zlib.crc32(str(key if key is not None else "").encode()) % 2 == 0 and "\n" in (doc[4] or "")
        assert r.verified == (not touched)
        if doc[0] != 5:
            assert r.proof_sha256 == h(*[a + b for a, b in proof])


def test_empty_table(spark, tmp_path):
    assert write(spark, tmp_path, []).collect() == []
