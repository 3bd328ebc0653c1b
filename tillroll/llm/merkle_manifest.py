"""A Merkle manifest of a table: leaf, subtree root, root and inclusion proof of every row.

Rows are leaves, one tree per ``lang`` in the order of ``doc_id``; the trees' roots
are the leaves of a last tree.  A parent is the hash of its two children, or of a
lone last child.  Trees are cut into aligned superblocks of ``2 ** LEVELS`` leaves:

* upwards, each superblock is reduced to one node, and those nodes are the leaves
  of the next tier, until every tree is one node;
* downwards, each tier's nodes and the outer nodes that their superblock needs (the
  siblings on the way from it to the root) are cogrouped by superblock, and one
  ``applyInArrow`` call finishes the local reduction, joins local and outer siblings
  to proofs and, on the lowest tier, folds every leaf with its proof to the root.

A superblock is at most ``2 ** LEVELS`` short rows whatever the size of its tree, so
a tree that holds most of the table is spread like the others.  Positions come
from a range-partitioned, written table (count per partition and tree, summed over
earlier partitions); rows that are equal are told apart by where they were read,
so many copies of one row are spread too.

Inputs: a null ``lang`` is a tree of its own, first in order; null ids come first
in their tree; rows equal in id and lang stand by their leaf's hash; empty texts
are values, not nulls; texts of any length are hashed by Spark's ``sha2``; other
columns are ignored whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import find_package, materialize

#: Levels of a superblock: 2,048 leaves.
LEVELS = 11
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A tree's key: empty for a null language, else "=" and the language, so that keys order as the languages do.
TOP = ""


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _encoded(column) -> object:
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(docs: DataFrame, tamper_every: int = 7) -> DataFrame:
    """``tree``, ``doc_id``, ``leaf`` of each row, and in ``tampered`` the leaf after tampering, where there is some."""
    of = {c: F.col(f"`{c}`") for c in FIELDS}
    leaf = lambda f: F.sha2(F.concat(*[_encoded(f[c]) for c in FIELDS]), 256)
    more = {**of, "n_chars": of["n_chars"].cast("decimal(38,0)") + 1}
    hit = (F.crc32(of["doc_id"].cast("string").cast("binary")) % tamper_every == 0) & of["n_chars"].isNotNull()
    return docs.select(F.concat(F.lit("="), of["lang"].cast("string")).alias("tree"), of["doc_id"].alias("doc_id"),
                       leaf(of).alias("leaf"), F.when(hit, leaf(more)).alias("tampered")).fillna(TOP, ["tree"])


def numbered(rows: DataFrame, tree: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Adds each row's place ``idx`` in its ``tree`` by ``order`` and the tree's size ``n``.

    No tree is held by one task: rows are range-partitioned and written with their
    partition and place in it; the counts of earlier partitions are added.
    """
    spark = rows.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [tree, *order, "_read"]
    laid = materialize(rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
                       .sortWithinPartitions(*keys).drop("_read").withColumn("_at", F.monotonically_increasing_id()), "merkle_order")
    part = F.shiftright("_at", 33).alias("_part")
    here = laid.groupBy(F.col(tree).alias("_tree"), part).agg(F.count("*").alias("_here"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_tree")
    before = F.sum("_here").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    here = here.select("_tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_off"), F.sum("_here").over(whole).alias("n"))
    same = (F.col(tree) == F.col("_tree")) & (F.shiftright("_at", 33) == F.col("_part"))
    return laid.join(here, same).select(*rows.columns, (F.col("_at") + F.col("_off")).alias("idx"), "n")


def _height(table: pa.Table, levels: int) -> int:
    """Levels that a superblock reduces: fewer in a tree that it holds whole."""
    return min(levels, max(0, table.column("n")[0].as_py() - 1).bit_length())


def _reduce(nodes: list[str], levels: int) -> list[list[str]]:
    """A superblock's nodes, level by level up to its own root."""
    out = [nodes]
    for _ in range(levels):
        nodes = [_hash("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def _path(levels: list[list[str]], at: int) -> list[str]:
    """Siblings from leaf ``at`` up to the superblock's root: "<" or ">" (the side it stands on) and the node, "=" for none."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append("=" if other >= len(nodes) else ("<" if other < at else ">") + nodes[other])
        at >>= 1
    return out


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for step in path:
        side, node = step[0], step[1:]
        leaf = _hash(node + leaf if side == "<" else leaf + node)
    return leaf


def proof_digest(path: Sequence[str]) -> str:
    return _hash("".join(step[1:] for step in path))


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("idx")


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """The next tier: one node for each superblock."""
    def work(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        n = table.column("n")[0].as_py()
        root = _reduce(table.column("node").to_pylist(), _height(table, levels))[-1][0]
        return pa.table({"tree": table.column("tree").slice(0, 1).cast(pa.string()), "idx": pa.array([table.column("idx")[0].as_py() >> levels]),
                         "n": pa.array([-(-n >> levels)]), "node": pa.array([root], pa.string())})

    return nodes.select("tree", "idx", "n", "node").groupBy("tree", F.shiftright("idx", levels)).applyInArrow(work, "tree string, idx bigint, n bigint, node string")


def _join(nodes: DataFrame, outer: DataFrame, levels: int, work, schema: str) -> DataFrame:
    """Cogroups a tier's nodes with the outer nodes of their superblocks."""
    right = outer.select(F.col("tree").alias("o_tree"), F.col("idx").alias("o_block"), "path", "subroot", "root")
    return nodes.groupBy("tree", F.shiftright("idx", levels)).cogroup(right.groupBy("o_tree", "o_block")).applyInArrow(work, schema)


def _down(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Each node's way to the root, from its superblock's."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _sorted(left)
        above, subroot, root = (right.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        count = left.num_rows
        tiers = _reduce(left.column("node").to_pylist(), _height(left, levels))
        return pa.table({"tree": left.column("tree").cast(pa.string()), "idx": left.column("idx"),
                         "path": pa.array([_path(tiers, k) + above for k in range(count)], pa.list_(pa.string())),
                         "subroot": pa.array([subroot] * count, pa.string()), "root": pa.array([root] * count, pa.string())})

    return _join(nodes, outer, levels, work, "tree string, idx bigint, path array<string>, subroot string, root string")


def _leaf_rows(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The lowest tier: proofs of the leaves, folded."""
    kind = nodes.schema["doc_id"].dataType.simpleString()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _sorted(left)
        above, subroot, root = (right.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        own, tampered = left.column("node").to_pylist(), left.column("tampered").to_pylist()
        tiers = _reduce(own, _height(left, levels))
        proofs, folded = [], []
        for k, node in enumerate(own):
            path = _path(tiers, k) + above
            proofs.append(proof_digest(path))
            folded.append(fold(tampered[k] or node, path))
        count = left.num_rows
        return pa.table({"doc_id": left.column("doc_id"), "leaf": left.column("node").cast(pa.string()),
                         "subroot": pa.array([subroot] * count, pa.string()), "root": pa.array([root] * count, pa.string()),
                         "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()),
                         "verified": pa.array(np.array([f == root for f in folded], bool))})

    return _join(nodes, outer, levels, work, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                     "folded_root string, verified boolean")


def _tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tiers from ``nodes`` up to the one with a single node for each tree, each written."""
    largest = nodes.agg(F.max("n")).first()[0] or 1
    out = [nodes]
    while largest > 1:
        out.append(materialize(_up(out[-1], levels), "merkle_tier"))
        largest = -(-largest >> levels)
    return out


def manifest(docs: DataFrame, tamper_every: int = 7, levels: int = LEVELS) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the siblings up to the root), ``folded_root``
    (from the tampered leaf, where there is one, and the siblings) and ``verified`` (it equals the root) of each row."""
    find_package(docs.sparkSession)
    hashed = materialize(leaves(docs, tamper_every), "merkle_leaves")
    low = _tiers(materialize(numbered(hashed, "tree", ["doc_id", "leaf"]).withColumnRenamed("leaf", "node"), "merkle_nodes"), levels)
    trees = low[-1].select("tree", "node")
    top = numbered(trees.select(F.lit(TOP).alias("all"), F.col("tree").alias("lang"), "node"), "all", ["lang"])
    top = _tiers(materialize(top.withColumnRenamed("all", "tree"), "merkle_top"), levels)
    outer = top[-1].select("tree", "idx", F.array().cast("array<string>").alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    for tier in reversed(top[:-1]):
        outer = materialize(_down(tier, outer, levels), "merkle_outer")
    # a tree's place in the last tree leads to its way from subroot to root
    place = top[0].select(F.col("idx").alias("_idx"), "lang", F.col("node").alias("_subroot"))
    outer = outer.join(place, F.col("idx") == F.col("_idx")).select(
        F.col("lang").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("_subroot").alias("subroot"), "root")
    for tier in reversed(low[1:-1] if len(low) > 1 else []):
        outer = materialize(_down(tier, outer, levels), "merkle_outer")
    return _leaf_rows(low[0], outer, levels)
