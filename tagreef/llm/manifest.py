"""Merkle manifest of a dataset, with a version of the tree for each tampered leaf.

Leaves of one group (language) stand in order of their ids; every two neighbours
become the hash of both, level by level, and a group's last node is its subroot.
Subroots, in order of their groups, become the root in the same way.

The tree is built in aligned blocks of ``2 ** BLOCK_LEVELS`` nodes. A block of
leaves is a persistent tree in one task; the roots of blocks are the leaves of
the next level of blocks, and so on, so that no task ever holds more than a
block. From the top down every block learns its path: the siblings of its root
and of that node's ancestors. With it, a tampered leaf makes a version of its
own: its ancestors within the block are copied, all other nodes are shared with
the untampered tree, and the version goes on along the block's path.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.llm.tables import stored
from tagreef.operators.numbering import with_index
from tagreef.operators.sizes import broadcast_if_small

BLOCK_LEVELS = 8
BLOCK = 1 << BLOCK_LEVELS

#: One step of a path: "L" or "R" and the sibling on that side, or "" for a node without one.
Path = list[str]


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    """The hash of a row's fields, one after the other."""
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


@dataclass(frozen=True)
class Node:
    """A node that is never changed; versions share it."""

    digest: str
    left: Node | None = None
    right: Node | None = None


def parent(left: Node, right: Node | None) -> Node:
    return Node(joined([left.digest] if right is None else [left.digest, right.digest]), left, right)


def block_height(nodes: int) -> int:
    """Levels that a block adds to a tree whose level has so many nodes: all, unless the tree ends in it."""
    return BLOCK_LEVELS if nodes > BLOCK else max(nodes - 1, 0).bit_length()


def build(digests: list[str], height: int) -> Node:
    level = [Node(d) for d in digests]
    for _ in range(height):
        level = [parent(level[k], level[k + 1] if k + 1 < len(level) else None) for k in range(0, len(level), 2)]
    return level[0]


def path_to(root: Node, place: int, height: int) -> Path:
    """Steps from the leaf at ``place`` up to the root of its block."""
    steps, node = [], root
    for bit in reversed(range(height)):
        other = node.left if place >> bit & 1 else node.right
        steps.append("" if other is None else ("L" if place >> bit & 1 else "R") + other.digest)
        node = node.right if place >> bit & 1 else node.left
    return steps[::-1]


def version(root: Node, place: int, height: int, digest: str) -> Node:
    """The tree with another leaf: only the leaf's ancestors are copied."""
    if height == 0:
        return Node(digest)
    if place >> (height - 1) & 1:
        return parent(root.left, version(root.right, place & ~(1 << (height - 1)), height - 1, digest))
    return parent(version(root.left, place, height - 1, digest), root.right)


def folded(digest: str, path: Path) -> str:
    """The root that a node and the siblings on its path make."""
    for step in path:
        digest = joined([step[1:], digest] if step[:1] == "L" else [digest, step[1:]])
    return digest


def siblings(path: Path) -> str:
    return "".join(step[1:] for step in path)


def _climbed(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, digest) of the last node of each tree, and a table for each level of blocks.

    ``nodes`` are (tree, at, n, digest), ``n`` nodes to a tree. A table has the
    path of each node within its block, and the block's number ``block``.
    """

    def lift(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        height = block_height(rows.column("n")[0].as_py())
        root = build(rows.column("digest").to_pylist(), height)
        paths = [path_to(root, k, height) for k in range(len(rows))]
        return pa.table(
            {
                "tree": rows.column("tree"), "at": rows.column("at"), "n": rows.column("n"), "block": rows.column("block"),
                "path": pa.array(paths, pa.list_(pa.string())), "top": pa.array([root.digest] * len(rows), pa.string()),
            }
        )

    levels = []
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        blocks = nodes.withColumn("block", F.floor(F.col("at") / BLOCK)).groupBy("tree", "block")
        level = stored(blocks.applyInArrow(lift, "tree long, at long, n long, block long, path array<string>, top string"), "manifest-level")
        levels.append(level)
        nodes = level.filter(F.col("at") % BLOCK == 0).select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest")
        )
    return nodes.select("tree", "digest"), levels


def _whole_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, at, path) of the lowest level's nodes; ``tops`` are the (tree, path) above the trees."""
    above = tops.withColumn("at", F.lit(0).cast("long"))
    for level in reversed(levels):
        up = above.select("tree", F.col("at").alias("block"), F.col("path").alias("rest"))
        above = level.join(up, ["tree", "block"]).select("tree", "at", F.concat("path", "rest").alias("path"))
    return above


def merkle_manifest(docs: DataFrame, leaf: Column, tampered: Column, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``leaf`` is a row's hash (hex); ``tampered`` is the hash that the row has now,
    or null where it has not changed. Leaves of a group stand in ascending order of
    ``key``, a null key first, rows of one key in order of their hashes; groups in
    bytewise order, null first, as a group of its own. While several nodes are
    left, each two neighbours (at the end perhaps one) become their hash.
    ``proof_sha256`` hashes the siblings on the way to the root (of nothing, for a
    lone row), ``folded_root`` is the root that the row's present leaf makes with
    them, ``verified`` whether it is the manifest's. Repeated rows are leaves of
    their own. An empty table has no rows and no root. Other columns play no part.

    Rows are numbered by a range sort of their hashes alone; texts are read once.
    """
    slim = docs.select(
        F.col(key).cast("long").alias("id"), F.col(group).cast("string").alias("name"),
        F.unhex(leaf).alias("leaf"), F.unhex(tampered).alias("changed"),
    )
    slim = stored(slim.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = with_index(slim, ["name", "id", "leaf", "row"], "place")
    groups = placed.groupBy("name").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = stored(with_index(groups, ["name"], "tree"), "manifest-groups")
    known = broadcast_if_small(groups.withColumnRenamed("name", "group_name"))
    leaves = placed.join(known, F.col("name").eqNullSafe(F.col("group_name")))
    at = F.col("place") - F.col("first")
    leaves = leaves.select("tree", "n", "id", at.alias("at"), F.floor(at / BLOCK).alias("block"), "leaf", "changed")
    leaves = stored(leaves, "manifest-leaves")

    def root_of(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        n = rows.column("n")[0].as_py()
        root = build([x.hex() for x in rows.column("leaf").to_pylist()], block_height(n))
        return pa.table({"tree": [key[0].as_py()], "at": [key[1].as_py()], "n": [-(-n // BLOCK)], "digest": [root.digest]})

    blocks = leaves.groupBy("tree", "block").applyInArrow(root_of, "tree long, at long, n long, digest string")
    blocks = stored(blocks, "manifest-blocks")
    subroots, levels = _climbed(blocks)
    # The trees' last nodes are the leaves of one tree more.
    subroots = stored(subroots, "manifest-subroots")
    many = F.lit(subroots.count()).cast("long")
    crown = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), many.alias("n"), "digest")
    root, crown_levels = _climbed(crown)
    empty = F.array().cast("array<string>")
    tops = root.select("tree", empty.alias("path"))
    tops = _whole_paths(crown_levels, tops).select(F.col("at").alias("tree"), "path")
    lowest = _whole_paths(levels, tops)
    top = root.first()
    ends = subroots.select("tree", F.col("digest").alias("subroot"), F.lit(top and top["digest"]).cast("string").alias("root"))
    upper = lowest.join(broadcast_if_small(ends), "tree").withColumnRenamed("at", "block")

    def verify(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        height = block_height(rows.column("n")[0].as_py())
        path, subroot, top = (above.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        hashes = [x.hex() for x in rows.column("leaf").to_pylist()]
        tree = build(hashes, height)
        whole = folded(tree.digest, path)
        rest = siblings(path)
        proofs, ends = [], []
        for k, changed in enumerate(rows.column("changed").to_pylist()):
            proofs.append(joined([siblings(path_to(tree, k, height)), rest]))
            ends.append(whole if changed is None else folded(version(tree, k, height, changed.hex()).digest, path))
        n = len(rows)
        return pa.table(
            {
                "id": rows.column("id"), "leaf": pa.array(hashes), "subroot": pa.array([subroot] * n),
                "root": pa.array([top] * n), "proof_sha256": pa.array(proofs), "folded_root": pa.array(ends),
                "verified": pa.array([end == top for end in ends]),
            }
        )

    kind = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    pairs = leaves.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
    return pairs.applyInArrow(verify, kind).withColumnRenamed("id", key)
