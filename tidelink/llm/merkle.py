"""Merkle manifest of a table, with one multiproof for each block of leaves.

Every row is a leaf: the SHA-256 of its fields. The leaves of one group, in
the order of their ids, form a binary tree, in which a last node without a
neighbour is hashed alone; the roots of the groups form one more tree, whose
root stands for the table. All nodes are a table (tree, level, idx, digest).

A tree is built in blocks of 4096 nodes a task, twelve levels at a time, so
the number of rounds is the depth over twelve. Proofs are made by blocks of
leaves as well: a block computes the minimal set of node coordinates that its
leaves cannot supply themselves (level by level, the siblings that none of
its own nodes covers), these are fetched once by a join, the interiors that
its leaves share are derived from both, and the proof of each leaf is read
off locally.

Defined results: null fields are ``-``; rows without a group form a group
that comes first; rows without an id come first in their group; rows of equal
ids are ordered by their leaves, so repeated rows are leaves each; a group of
one has its leaf as its root; an empty table has no leaves, nodes or proofs.
All columns travel as one struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.operators.scan import positioned
from tidelink.session import materialize

BLOCK_LEVELS = 12
TOP = -1  # the tree of the groups' roots


def field(value: Column) -> Column:
    """A field as it enters a leaf: byte count, colon, value; ``-`` if null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def joined(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return (int(n) - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes of a level."""
    return -(-int(n) >> level)


def parents(level: dict[int, str]) -> dict[int, str]:
    """The nodes above, from a level's nodes; both children must be there."""
    return {i >> 1: joined(d, level[i + 1]) if i + 1 in level else joined(d) for i, d in level.items() if not i & 1}


def missing_nodes(leaves: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The least set of (level, idx) that, with these leaves of a tree of n,
    gives all their proofs."""
    need, own = [], set(leaves)
    for level in range(levels_of(n)):
        need += sorted((level, i ^ 1) for i in own if i ^ 1 not in own and i ^ 1 < width(n, level))
        own = {i >> 1 for i in own}
    return need


def derived(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """All nodes by level that the leaves and the fetched nodes give."""
    found = []
    level = dict(leaves)
    for k in range(levels_of(n) + 1):
        level |= {i: d for (at, i), d in fetched.items() if at == k}
        found.append(level)
        level = parents(level)
    return found


def siblings(nodes: list[dict[int, str]], leaf: int, n: int) -> list[tuple[bool, str]]:
    """(stands left, digest) of a leaf's siblings, from the lowest level up."""
    path = []
    for k in range(levels_of(n)):
        beside = (leaf >> k) ^ 1
        path.append((beside < leaf >> k, nodes[k][beside]) if beside < width(n, k) else (False, ""))
    return path


def folded(leaf: str, path: Sequence[tuple[bool, str]]) -> str:
    for left, digest in path:
        leaf = joined(digest, leaf) if left else joined(leaf, digest)
    return leaf


@dataclass(frozen=True)
class Manifest:
    """``leaves``: every row (a struct), its leaf, tree, idx, n (leaves of the
    tree) and trees (their number); ``nodes``: tree, level, idx, n, digest."""

    leaves: DataFrame
    nodes: DataFrame


def _grow(leaves: DataFrame, block_levels: int) -> DataFrame:
    """Nodes of all levels of the trees over (tree, idx, n, digest)."""
    schema = "tree long, level int, idx long, n long, digest string"

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        tree, base, n = int(rows["tree"].iloc[0]), int(rows["level"].iloc[0]), int(rows["n"].iloc[0])
        level, out = dict(zip(rows["idx"].tolist(), rows["digest"])), []
        for k in range(base + 1, min(base + block_levels, levels_of(n)) + 1):
            level = parents(level)
            out += [(tree, k, i, n, d) for i, d in level.items()]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "n", "digest"])

    nodes = base = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 1
    for top in range(block_levels, levels_of(most) + block_levels, block_levels):
        grown = materialize(base.groupBy("tree", F.shiftright("idx", block_levels).alias("_b")).applyInPandas(block, schema))
        nodes = nodes.union(grown)
        base = grown.where((F.col("level") == top) & (F.col("n") > F.lit(1 << top)))
    return nodes


def build(rows: DataFrame, group_col: str, id_col: str, leaf_col: str, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of rows that carry their leaf digest."""
    rows = rows.select(F.struct("*").alias("row"), F.col(group_col).alias("g"), F.col(id_col).alias("id"),
                       F.col(leaf_col).alias("leaf"))
    placed = positioned(rows, ["g", "id", "leaf"], out="at")
    groups = placed.groupBy(F.col("g").alias("same")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(positioned(groups, ["same"], out="tree"))
    groups = groups.withColumn("trees", groups.agg(F.count(F.lit(1))).scalar())
    leaves = materialize(placed.join(groups, F.col("g").eqNullSafe(F.col("same"))).select(
        "row", "leaf", "tree", (F.col("at") - F.col("first")).alias("idx"), "n", "trees"))
    inner = _grow(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest")), block_levels)
    # a tree's root is its one node on the level that its size gives
    alone = F.expr("idx = 0 AND shiftleft(1L, level) >= n")
    roots = inner.where(alone).join(groups.select("tree", "trees"), "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), "digest")
    return Manifest(leaves, materialize(inner.union(_grow(materialize(roots), block_levels))))


def prove(manifest: Manifest, claimed: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The proof of every leaf, and the root to which it folds the leaf that
    ``claimed`` (over the manifest's ``row``) gives, or else its own.

    Returns row, leaf, subroot and root (as the manifest has them), proof
    (the siblings' digests from the leaf to the root) and folded_root.
    """
    block = F.shiftright("idx", block_levels)
    claim = F.col("leaf") if claimed is None else F.coalesce(claimed, F.col("leaf"))
    leaves = manifest.leaves.select("row", "leaf", claim.alias("claimed"), "tree", "idx", "n", "trees",
                                    block.alias("block"))

    def wanted(part: pd.DataFrame) -> pd.DataFrame:
        tree, n, trees, b = (int(part[c].iloc[0]) for c in ("tree", "n", "trees", "block"))
        rows = [(tree, b, tree, k, i) for k, i in missing_nodes(part["idx"].tolist(), n)]
        rows += [(tree, b, TOP, k, i) for k, i in missing_nodes([tree], trees)]
        rows += [(tree, b, tree, levels_of(n), 0), (tree, b, TOP, levels_of(trees), 0)]  # what proofs must meet
        return pd.DataFrame(rows, columns=["part", "block", "tree", "level", "idx"])

    need = materialize(leaves.select("tree", "idx", "n", "trees", "block").groupBy("tree", "block")
                       .applyInPandas(wanted, "part long, block long, tree long, level int, idx long"))
    fetched = materialize(need.join(manifest.nodes, ["tree", "level", "idx"])
                          .select("part", "block", "tree", "level", "idx", "digest"))

    def expanded(part: pa.Table, fetch: pa.Table) -> pa.Table:
        tree, n, trees = (part[c][0].as_py() for c in ("tree", "n", "trees"))
        got: dict[int, dict[tuple[int, int], str]] = {tree: {}, TOP: {}}
        for t, k, i, d in zip(*(fetch[c].to_pylist() for c in ("tree", "level", "idx", "digest"))):
            got[t][k, i] = d
        subroot, root = got[tree][levels_of(n), 0], got[TOP][levels_of(trees), 0]
        places, leaf = part["idx"].to_pylist(), part["leaf"].to_pylist()
        nodes = derived(dict(zip(places, leaf)), got[tree], n)
        above = siblings(derived({tree: subroot}, got[TOP], trees), tree, trees)
        paths = [siblings(nodes, i, n) + above for i in places]
        out = part.select(["row", "leaf"])
        for name, values in {
                "subroot": [subroot] * len(paths), "root": [root] * len(paths),
                "proof": [[d for _, d in p if d] for p in paths],
                "folded_root": [folded(c, p) for c, p in zip(part["claimed"].to_pylist(), paths)]}.items():
            out = out.append_column(name, pa.array(values, pa.list_(pa.string()) if name == "proof" else pa.string()))
        return out

    row = leaves.schema["row"].dataType.simpleString()
    return (leaves.groupBy("tree", "block").cogroup(fetched.groupBy("part", "block")).applyInArrow(
        expanded, f"row {row}, leaf string, subroot string, root string, proof array<string>, folded_root string"))
