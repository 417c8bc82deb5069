"""Merkle manifest of a dataset: persistent path-copying trees over aligned blocks of leaves.

Every row is a leaf, every value of ``tree`` a tree of its leaves in the order of their ids, and the subroots of the
trees, in the order of their names (null first, by UTF-8 bytes), are the leaves of one last tree. A run of three
neighbouring nodes becomes their parent, until one node is left; the last run may be shorter, even one node.

A tree is worked on in aligned blocks of ``FANOUT ** LEVELS`` neighbouring nodes. On the way up each block yields the one
node above it, so every round leaves 1/2187 of the nodes, and a round is one grouping by (tree, block): no task holds
more than a block, however large a tree is. On the way down the path of each block to the root is put together from
its path inside the block above and the path of that block. A tampered leaf makes a version: it shares every node
outside its path with the untampered tree; its ancestors are copied inside its own block and then along the
path of the block through the upper rounds. Versions are worked on where their leaf is, so no task collects them.

Nulls and edge cases: null fields have their own spelling in the leaf; a null tree name is a tree of its own, the first.
Rows without id come first in their tree; rows that repeat an id follow each other in the order of their digests, and equal rows
have equal digests, so that only their places differ. An empty table gives an empty manifest. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut

#: Nodes of a run, and levels of an aligned block.
FANOUT, LEVELS = 3, 7
BLOCK = FANOUT**LEVELS


class Manifest(NamedTuple):
    """``leaves``: one row per row of the dataset with its proof and, where it was tampered with, its version.
    ``nodes``: every node of the untampered trees above the leaves, ``tree, level, position, digest``; the last tree
    of subroots is named null in ``tree`` and has ``top`` true.
    """

    leaves: DataFrame
    nodes: DataFrame


def digest_of(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def parent(children: Sequence[bytes]) -> bytes:
    """Digest of a run, digests as hexadecimal text inside; in and out as 32 bytes."""
    return sha256(b"".join(children).hex().encode()).digest()


def levels_of(nodes: list[bytes], size: int) -> list[list[bytes]]:
    """The levels of a block, its own nodes first. ``size`` is that of the whole tree at this height: a tree that
    fits in one block is worked on to its root, one that does not by all levels of the block."""
    levels = [nodes]
    while len(levels) <= LEVELS if size > BLOCK else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([parent(last[k : k + FANOUT]) for k in range(0, len(last), FANOUT)])
    return levels


def path_in(levels: list[list[bytes]], place: int) -> list[tuple[list[bytes], list[bytes]]]:
    """Siblings to the left and to the right of a node and of its ancestors inside a block."""
    out = []
    for nodes in levels[:-1]:
        run = place - place % FANOUT
        out.append((nodes[run:place], nodes[place + 1 : run + FANOUT]))
        place //= FANOUT
    return out


def packed(path: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    return b"".join(bytes((len(left), len(right))) + b"".join(left + right) for left, right in path)


def unpacked(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        nodes = [path[k : k + 32] for k in range(at + 2, at + 2 + 32 * (left + right), 32)]
        out.append((nodes[:left], nodes[left:]))
        at += 2 + 32 * (left + right)
    return out


def copies(leaf: bytes, path: list[tuple[list[bytes], list[bytes]]]) -> list[bytes]:
    """The ancestors of a new leaf, each made from its new child and the shared siblings; the last is the root."""
    out = []
    for left, right in path:
        leaf = parent([*left, leaf, *right])
        out.append(leaf)
    return out


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``size``, the rows of their ``tree``, and ``pos``, their place in it, ascending by ``order``.

    Rows are dealt out by range, so a large tree lies in many tasks; the place is that inside the task plus the
    rows of the tasks before, of which there is one count for each task and tree.
    """
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Written before it is counted: what is counted is what is read again.
    rows = cut(ordered.withColumn("_at", F.monotonically_increasing_id()), "merkle-leaves").withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(tree).alias("size"))
    return rows.join(runs, ["tree", "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


def block_rows(table: pa.Table, *columns: str) -> list[tuple]:
    """The rows of a block by place: pos, size, digest, then ``columns``."""
    return sorted(zip(*[table.column(c).to_pylist() for c in ("pos", "size", "digest", *columns)], strict=True), key=lambda r: r[0])


def climb(nodes: DataFrame) -> DataFrame:
    """One node for each block, at its place among the blocks of its tree."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = block_rows(table)
        top = levels_of([r[2] for r in rows], rows[0][1])[-1][0]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "size": [-(-rows[0][1] // BLOCK)], "pos": pa.array([key[1].as_py()], pa.int64()), "digest": pa.array([top], pa.binary())})

    return in_blocks(nodes.select("tree", "size", "pos", "digest")).groupBy("tree", "block").applyInArrow(run, "tree string, size long, pos long, digest binary")


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes at the foot of each round, and at last the root of each tree."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    out = [nodes]
    while True:
        out.append(cut(climb(out[-1]), "merkle-nodes"))
        if largest <= BLOCK:
            return out
        largest = -(-largest // BLOCK)


UPPER = "tree string, block long, path binary, subroot binary, root binary"


def descend(nodes: DataFrame, upper: DataFrame) -> DataFrame:
    """Paths to the root of all ``nodes``, from the paths of their blocks. Nodes are the blocks of the round below."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows, above = block_rows(left), right.to_pylist()[0]
        levels = levels_of([r[2] for r in rows], rows[0][1])
        n = len(rows)
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * n, pa.string()),
                "block": pa.array([r[0] for r in rows], pa.int64()),
                "path": pa.array([packed(path_in(levels, k)) + above["path"] for k in range(n)], pa.binary()),
                "subroot": pa.array([above["subroot"]] * n, pa.binary()),
                "root": pa.array([above["root"]] * n, pa.binary()),
            }
        )

    own = in_blocks(nodes.select("tree", "size", "pos", "digest"))
    return own.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(run, UPPER)


def inner_nodes(foot: DataFrame, low: int) -> DataFrame:
    """The nodes above ``foot`` inside its blocks; ``low`` is the level of ``foot``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows, block = block_rows(table), key[1].as_py()
        levels = levels_of([r[2] for r in rows], rows[0][1])
        found = [(low + level, block * BLOCK // FANOUT**level + k, d) for level in range(1, len(levels)) for k, d in enumerate(levels[level])]
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * len(found), pa.string()),
                "level": pa.array([f[0] for f in found], pa.int32()),
                "position": pa.array([f[1] for f in found], pa.int64()),
                "digest": pa.array([f[2].hex() for f in found], pa.string()),
            }
        )

    return in_blocks(foot.select("tree", "size", "pos", "digest")).groupBy("tree", "block").applyInArrow(run, "tree string, level int, position long, digest string")


def tree_name(tree: Column) -> Column:
    """The name a tree had before names got a letter in front, so that null could come first."""
    return F.when(tree.startswith("s"), F.substring(tree, 2, (1 << 31) - 1))


def node_rows(feet: list[DataFrame], top: bool) -> DataFrame:
    """All nodes above the leaves."""
    parts = [inner_nodes(foot, n * LEVELS) for n, foot in enumerate(feet[:-1])]
    return reduce(DataFrame.unionByName, parts).select(tree_name(F.col("tree")).alias("tree"), F.lit(top).alias("top"), "level", "position", "digest")


def manifest(
    rows: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_: str = "doc_id",
    tree: str = "source",
    tampered: Column | None = None,
    tampered_field: tuple[str, Column] | None = None,
) -> Manifest:
    """Leaves with their proofs and versions, and the nodes they share.

    Where ``tampered`` is true, the field named in ``tampered_field`` gets the value of its column, and the row becomes a
    version. Leaves have the id under ``id_``, ``tree``, ``position``, ``leaf``, ``subroot``, ``root``, ``proof`` (all siblings
    one after the other, level by level, left to right), ``folded_root`` (the new or unchanged leaf folded with the
    untampered siblings), ``verified`` and ``copied``: the nodes of the version from the lowest ancestor to its root,
    null where there is none.
    """
    plain = [F.col(f"`{f}`") for f in fields]
    leaf = F.unhex(digest_of(plain))
    changed = leaf
    is_tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    if tampered_field is not None:
        new = [tampered_field[1] if f == tampered_field[0] else c for f, c in zip(fields, plain, strict=True)]
        changed = F.when(is_tampered, F.unhex(digest_of(new)))
    else:
        changed = F.when(is_tampered, leaf)
    name = F.col(f"`{tree}`").cast("string")
    leaves = rows.select(
        F.col(f"`{id_}`").cast("long").alias("id"), F.when(name.isNull(), "").otherwise(F.concat(F.lit("s"), name)).alias("tree"), leaf.alias("digest"), changed.alias("changed")
    )
    nodes = placed(leaves, "id", "digest")
    feet = rounds(nodes)

    subroots = placed(feet[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "name")
    top = rounds(subroots)
    nothing = F.lit(b"")
    upper = top[-1].select("tree", F.lit(0).cast("long").alias("block"), nothing.alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    for foot in reversed(top[:-1]):
        upper = descend(foot, upper)
    upper = upper.drop("subroot", "tree").withColumnRenamed("block", "pos").join(subroots.select("pos", F.col("name").alias("tree"), F.col("digest").alias("subroot")), "pos")
    upper = cut(upper.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root"), "merkle-paths")
    for foot in reversed(feet[1:-1]):
        upper = descend(foot, upper)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows, above = block_rows(left, "id", "changed"), right.to_pylist()[0]
        levels, over = levels_of([r[2] for r in rows], rows[0][1]), unpacked(above["path"])
        n, proofs, roots, versions = len(rows), [], [], []
        for k, (_, _, digest, _, new) in enumerate(rows):
            path = path_in(levels, k) + over
            proofs.append("".join(b"".join(a + b).hex() for a, b in path))
            made = copies(digest if new is None else new, path)
            roots.append(made[-1] if made else digest if new is None else new)
            versions.append(None if new is None else [m.hex() for m in made])
        return pa.table(
            {
                "id": pa.array([r[3] for r in rows], pa.int64()),
                "tree": pa.array([key[0].as_py()] * n, pa.string()),
                "position": pa.array([r[0] for r in rows], pa.int64()),
                "leaf": pa.array([r[2].hex() for r in rows], pa.string()),
                "subroot": pa.array([above["subroot"].hex()] * n, pa.string()),
                "root": pa.array([above["root"].hex()] * n, pa.string()),
                "proof": pa.array(proofs, pa.string()),
                "folded_root": pa.array([r.hex() for r in roots], pa.string()),
                "verified": pa.array([r == above["root"] for r in roots], pa.bool_()),
                "copied": pa.array(versions, pa.list_(pa.string())),
            }
        )

    schema = "id long, tree string, position long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean, copied array<string>"
    below = in_blocks(nodes.select("tree", "size", "pos", "digest", "id", "changed"))
    found = below.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(run, schema)
    found = found.withColumn("tree", tree_name(F.col("tree"))).withColumnRenamed("id", id_)
    return Manifest(found, node_rows(feet, False).unionByName(node_rows(top, True)))


def digests(documents: DataFrame, tampered: Column, tampered_field: tuple[str, Column]) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each document."""
    leaves = manifest(documents, tampered=tampered, tampered_field=tampered_field).leaves
    return leaves.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
