import hashlib

import pytest
from pyspark.sql import functions as F

from tagreef.llm.manifest import BLOCK, block_height, build, folded, leaf_of, merkle_manifest, path_to, version

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
KIND = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 2])) for k in range(0, len(last), 2)])
    return levels


def way(levels, k):
    out = []
    for level in levels[:-1]:
        out.append((level[k ^ 1] if k ^ 1 < len(level) else "", k % 2))
        k //= 2
    return out


def brute(rows, changed):
    """The contract, one row at a time; rows of one id stand in order of their hashes."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = {n: sorted(groups[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for n in names}
    trees = {n: climb([leaf(r) for r in order[n]]) for n in names}
    crown = climb([trees[n][-1][0] for n in names])
    out = []
    for i, n in enumerate(names):
        for k, row in enumerate(order[n]):
            steps = way(trees[n], k) + way(crown, i)
            end = leaf((*row[:3], row[3] + 1, row[4])) if changed(row) and row[3] is not None else leaf(row)
            for other, left in steps:
                end = sha(other + end if left else end + other)
            root = crown[-1][0]
            out.append((row[0], leaf(row), trees[n][-1][0], root, sha("".join(s for s, _ in steps)), end, end == root))
    return sorted(out, key=repr)


def manifest(spark, rows):
    docs = spark.createDataFrame(rows, KIND)
    docs = docs.selectExpr("*", "1 AS place", "2 AS tree", "'x' AS root", "'y' AS leaf")
    changed = (F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS)
    out = merkle_manifest(docs, leaf_of(*map(F.col, COLUMNS)), F.when(F.col("doc_id") % 3 == 0, leaf_of(*changed)))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def every_third(row):
    return row[0] is not None and row[0] % 3 == 0


@pytest.mark.parametrize("n", [1, 3, BLOCK, 3 * BLOCK + 7])
def test_sizes(spark, n):
    rows = [(k, "s", "en", k, f"text {k}") for k in range(n)]
    assert manifest(spark, rows) == brute(rows, every_third)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (3, "s", "en", None, "no count"), (3, "s", "en", 5, "another"),
        (6, "é", "de", 1, "ü" * 3), (6, "é", "de", 1, "ü" * 3), (None, "s", "en", 3, "no id"), (9, "-", "Z", -4, "w " * 200_000),
        *((k, "s", "fr", k, "x") for k in range(20, 20 + BLOCK + 3)),
    ]
    found = manifest(spark, rows)
    assert found == brute(rows, every_third)
    wrong = {r[0] for r in found if not r[-1]}
    assert 3 in wrong and 6 in wrong and None not in wrong and 1 not in wrong


def test_many_groups(spark):
    rows = [(k, "s", f"l{k % 300}", k, "t") for k in range(900)]
    assert manifest(spark, rows) == brute(rows, every_third)


def test_no_rows(spark):
    assert manifest(spark, []) == []


def test_versions_share_untouched_nodes():
    tree = build([sha(str(k)) for k in range(6)], 3)
    other = version(tree, 4, 3, sha("new"))
    assert other.left is tree.left and other.right.left.right is tree.right.left.right
    assert other.digest == folded(sha("new"), path_to(tree, 4, 3)) != tree.digest
    assert tree.digest == folded(sha("4"), path_to(tree, 4, 3))


def test_heights():
    assert [block_height(n) for n in (1, 2, 3, BLOCK, BLOCK + 1)] == [0, 1, 2, 8, 8]
