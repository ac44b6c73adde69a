"""A Merkle manifest of a table: a tree per group, a tree over the groups' roots, proofs and their check. DataFrame code only.

* A row's leaf hashes its columns, each written as its size and value. Leaves are numbered in order per group by one global
  numbering (range partitions and their counts), so a group that holds a third of all rows is no task of its own.
* A slot pivot makes a level: the children of a parent are spread into ``FANOUT`` columns by conditional aggregates, which
  Spark combines before the shuffle; concatenating the columns and hashing them gives the parent. A level has an eighth of
  the rows of the one below, and is written, for it is read twice.
* On the way down a parent's columns become its children again: omitting the own column leaves a child's siblings. A child
  carries them on top of its parent's, so a leaf arrives with its whole proof and no shuffle of leaves takes place.

Hashes are SHA-256 in lower-case hexadecimal, of concatenated inputs; digests are inputs in that form.

Defined results: NULL fields count as ``-``; NULL is a group of its own and comes first; NULL keys come first in their group;
rows of one key stand in the order of their leaves, and fully repeated rows are leaves of their own; an empty table has no
root and no row; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead.functions.tables import dense_id
from deadhead.llm.common import materialize

FANOUT = 8
SLOTS = tuple(f"slot{k}" for k in range(FANOUT))
PATH = "array<struct<left:string,right:string>>"


def written(value: Column) -> Column:
    """A field as its UTF-8 byte count, a colon and its text; NULL as a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def _joined(digests: Sequence[Column]) -> Column:
    return F.concat_ws("", *digests) if digests else F.lit("")


def _climb(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels (tree, n, up, slots) from the bottom, and each tree's (tree, root).

    Nodes have a tree, the number ``n`` of its nodes, a place ``at`` and a struct ``node`` with a digest.
    """
    levels, tops = [], [nodes.filter("n = 1").select("tree", F.col("node.digest").alias("root"))]
    while most > 1:
        up, slot = F.floor(F.col("at") / FANOUT).cast("long"), F.col("at") % FANOUT
        spread = [F.max(F.when(slot == k, F.col("node"))).alias(c) for k, c in enumerate(SLOTS)]
        level = materialize(nodes.filter("n > 1").groupBy("tree", "n", up.alias("up")).agg(*spread), f"merkle-{name}")
        digest = F.sha2(_joined([F.col(c)["digest"] for c in SLOTS]), 256)
        nodes = level.select("tree", F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), F.col("up").alias("at"), F.struct(digest.alias("digest")).alias("node"))
        levels.append(level)
        tops.append(nodes.filter("n = 1").select("tree", F.col("node.digest").alias("root")))
        most = -(-most // FANOUT)
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return levels, roots


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame | None:
    """(tree, at, node, path, ...) of the lowest nodes of trees of several nodes; ``tops`` has a tree's path and more columns."""
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    above: DataFrame | None = None
    for level in reversed(levels):
        # the root of a tree is the only parent of its level
        parents = level.filter(F.col("n") <= FANOUT).join(tops, "tree")
        if above is not None:
            higher = above.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), "path", *extra)
            below = level.filter(F.col("n") > FANOUT)
            below = below.join(higher, (below["tree"] == F.col("_tree")) & (below["up"] == F.col("_at"))).drop("_tree", "_at")
            parents = parents.unionByName(below)
        digests = [F.col(c)["digest"] for c in SLOTS]
        children = F.array(
            *[
                F.struct(F.lit(k).alias("slot"), F.col(c).alias("node"), F.struct(_joined(digests[:k]).alias("left"), _joined(digests[k + 1 :]).alias("right")).alias("step"))
                for k, c in enumerate(SLOTS)
            ]
        )
        out = parents.withColumn("_child", F.explode(children)).filter("_child.node is not null")
        above = out.select(
            "tree", (F.col("up") * FANOUT + F.col("_child.slot")).alias("at"), F.col("_child.node").alias("node"), F.concat(F.array("_child.step"), F.col("path")).alias("path"), *extra
        )
    return above


@dataclass(frozen=True)
class Manifest:
    """Written tables: leaves, the levels of the groups' trees and of the tree over them, and groups with their roots."""

    leaves: DataFrame  # tree, n, at, node (digest, key, carried columns)
    levels: list[DataFrame]
    upper: list[DataFrame]
    groups: DataFrame  # tree, group, n, subroot
    root: str | None
    key: str
    carried: tuple[str, ...]

    def proofs(self) -> DataFrame:
        """(key, group, leaf, subroot, root, path, carried columns) of every row.

        ``path`` has for each level, from the leaf up, the digests left and right of the own one among its siblings.
        """
        none = F.array().cast(PATH)
        subroots = self.groups.select(F.col("tree").alias("at"), "group", "subroot", F.lit(self.root).alias("root"))
        found = _descend(self.upper, self.groups.sparkSession.range(1).select(F.lit(0).cast("long").alias("tree"), none.alias("path")))
        paths = subroots.withColumn("path", none) if found is None else subroots.join(found.select("at", "path"), "at")
        tops = materialize(paths.withColumnRenamed("at", "tree"), "merkle-tops")
        alone = self.leaves.filter("n = 1").select("tree", "node").join(tops, "tree")
        many = _descend(self.levels, tops)
        columns = ["node", "group", "subroot", "root", "path"]
        every = alone.select(*columns) if many is None else many.select(*columns).unionByName(alone.select(*columns))
        own = [F.col("node")["key"].alias(self.key), "group", F.col("node")["digest"].alias("leaf"), "subroot", "root", "path"]
        return every.select(*own, *[F.col("node")[f"carried{k}"].alias(c) for k, c in enumerate(self.carried)])


def manifest(docs: DataFrame, columns: Sequence[str], key: str, group: str, carry: dict[str, Column] | None = None) -> Manifest:
    """Hash ``columns`` of every row into a tree per ``group``, in order of ``key``. ``carry``: columns that proofs bring back."""
    carry = carry or {}
    rows = docs.select(
        F.col(group).alias("group"), F.col(key).alias("key"), leaf_hash([F.col(c) for c in columns]).alias("digest"), *[v.alias(f"carried{k}") for k, v in enumerate(carry.values())]
    )
    # the last key parts rows that are equal in full, whose order does not matter
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    placed = dense_id(rows, ["group", "key", "digest", "_row"], "place")
    groups = materialize(placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n")), "merkle-groups")
    groups = materialize(dense_id(groups, ["group"], "tree").withColumn("tree", F.col("tree") - 1), "merkle-groups")
    own = groups.withColumnRenamed("group", "_group")
    node = F.struct("digest", "key", *[f"carried{k}" for k in range(len(carry))])
    leaves = placed.join(own, F.col("group").eqNullSafe(F.col("_group"))).select("tree", "n", (F.col("place") - F.col("first")).alias("at"), node.alias("node"))
    most, trees = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    levels, roots = _climb(leaves, most, "level")
    groups = materialize(groups.join(roots, "tree").select("tree", "group", "n", F.col("root").alias("subroot")), "merkle-roots")
    nodes = groups.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), F.col("tree").alias("at"), F.struct(F.col("subroot").alias("digest")).alias("node"))
    upper, top = _climb(nodes, trees, "upper")
    root = top.first()
    return Manifest(leaves, levels, upper, groups, root.root if root else None, key, tuple(carry))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """One hash over all siblings of a proof, from the lowest level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)
