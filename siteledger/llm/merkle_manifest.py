"""Merkle dataset manifest by slot pivots: conditional aggregates spread the children of a node into columns.

A tree for each group of rows, and a tree over the groups' roots.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keep

FANOUT = 2
# Children that one pivot spreads into columns: several levels of a narrow tree share a shuffle.
MOST_COLUMNS = 16
ONE_GROUP = ""


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*columns: Column) -> Column:
    """Hash of a row's columns: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    texts = [c.cast("string") for c in columns]
    return hashed(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def group_key(group: Column) -> Column:
    """The group's name as text that is never null; null comes first, others by their UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(ONE_GROUP))


@dataclass(frozen=True)
class Tree:
    """``strata``: written tables, one row for each pivoted block of nodes; ``tops``: (g, stratum, top) per group."""

    strata: list[DataFrame]
    tops: DataFrame
    fanout: int
    levels: int


@dataclass(frozen=True)
class Manifest:
    """``subroots``: (g, subroot) per group; ``root`` is null only where there are no rows."""

    groups: Tree
    over: Tree
    subroots: DataFrame
    root: str | None


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in the order inside group ``g``, and ``n``, the group's rows.

    One sort over all tasks, so a group of any size spans many of them; the written order fixes the places.  Windows
    cover one row for each group and sorted partition.
    """
    ordered = keep(rows.orderBy("g", *order).withColumn("m", F.monotonically_increasing_id()), "placed") \
        .withColumn("piece", F.shiftright("m", 33))
    pieces = ordered.groupBy("g", "piece").agg(F.count("*").alias("size"), F.min("m").alias("first"))
    along = Window.partitionBy("g").orderBy("piece")
    shifts = pieces.select("g", "piece", (F.sum("size").over(along) - F.col("size") - F.col("first")).alias("shift"),
                           F.sum("size").over(Window.partitionBy("g")).alias("n"))
    return ordered.join(shifts, ["g", "piece"]).withColumn("pos", F.col("m") + F.col("shift")) \
        .drop("m", "piece", "shift")


def _pivot(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row for each block of fanout**levels nodes: children in columns s0, s1, ..., digests of level j in dj_0, ...

    ``depth`` is the number of levels that the block's group still needs, ``levels`` at most; ``top`` the digest there.
    Aggregates combine before the shuffle, where a block's nodes are neighbours already.
    """
    width = fanout ** levels
    slot = F.pmod("pos", F.lit(width))
    blocks = nodes.groupBy("g", F.floor(F.col("pos") / width).alias("block")).agg(
        F.max("n").alias("n"), *[F.max(F.when(slot == i, F.col("node"))).alias(f"s{i}") for i in range(width)])
    blocks = blocks.withColumns({f"d0_{i}": F.col(f"s{i}.digest") for i in range(width)})
    for j in range(levels):
        runs = range(width // fanout ** (j + 1))
        blocks = blocks.withColumns({f"d{j + 1}_{i}": F.when(F.col(f"d{j}_{fanout * i}").isNotNull(), hashed(
            *[F.coalesce(f"d{j}_{fanout * i + k}", F.lit("")) for k in range(fanout)])) for i in runs})
    depth, top = F.lit(0), F.col("d0_0")
    for j in range(levels):
        deeper = F.col("n") > fanout ** j
        depth, top = F.when(deeper, j + 1).otherwise(depth), F.when(deeper, F.col(f"d{j + 1}_0")).otherwise(top)
    return blocks.withColumn("depth", depth).withColumn("top", top)


def _climb(nodes: DataFrame, fanout: int, label: str) -> Tree:
    """Pivot after pivot up to one node per group; each table is written, the next one is smaller by the block's width."""
    levels = 1
    while fanout ** (levels + 1) <= MOST_COLUMNS:
        levels += 1
    width = fanout ** levels
    strata, tops = [], None
    while True:
        table = keep(_pivot(nodes, fanout, levels), label)
        ended = table.where(F.col("n") <= width).select("g", F.lit(len(strata)).alias("stratum"), "top")
        strata, tops = [*strata, table], ended if tops is None else tops.unionAll(ended)
        open_blocks = table.where(F.col("n") > width)
        if open_blocks.isEmpty():
            return Tree(strata, tops, fanout, levels)
        nodes = open_blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"),
                                   F.struct(F.col("top").alias("digest")).alias("node"))


def _siblings(slot: int, fanout: int, levels: int) -> Column:
    """For each level of a block the hex digests left and right of the slot's own one in its run."""
    steps = []
    for j in range(levels):
        own = slot // fanout ** j
        first = own - own % fanout
        sides = [[F.coalesce(f"d{j}_{i}", F.lit("")) for i in span]
                 for span in (range(first, own), range(own + 1, first + fanout))]
        left, right = [F.concat(*side) if side else F.lit("") for side in sides]
        steps.append(F.struct(left.alias("before"), right.alias("after")))
    return F.slice(F.array(*steps), F.lit(1), F.col("depth"))


def _descend(tree: Tree, starts: DataFrame) -> DataFrame:
    """(g, node, proof, subroot): each leaf with its siblings upward; ``starts`` has g, stratum, proof, subroot per group.

    Only the rows of one stratum and the paths of its blocks are joined, a width-th of the leaves at the widest.
    """
    width, paths = tree.fanout ** tree.levels, None
    for stratum in reversed(range(len(tree.strata))):
        entering = starts.where(F.col("stratum") == stratum).select("g", F.lit(0).cast("bigint").alias("block"), "proof", "subroot")
        paths = entering if paths is None else paths.unionAll(entering)
        found = tree.strata[stratum].join(paths, ["g", "block"])
        slots = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"s{i}").alias("node"),
                                   _siblings(i, tree.fanout, tree.levels).alias("own")) for i in range(width)])
        nodes = found.select("g", "block", "proof", "subroot", F.inline(slots)).where(F.col("node").isNotNull()) \
            .withColumn("proof", F.concat("own", "proof"))
        paths = nodes.select("g", (F.col("block") * width + F.col("slot")).alias("block"), "proof", "subroot")
    return nodes.select("g", "node", "proof", "subroot")


def build(leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT) -> Manifest:
    """The manifest of ``leaves``: ``g`` (see ``group_key``), ``node`` (a struct with ``digest``) and the ``order`` columns.

    Leaves follow ``order`` inside their group.  While a group has several nodes, each ``fanout`` neighbours become
    their hash, the last run perhaps of fewer; a lone leaf is the group's subroot.  The subroots, ordered by ``g``, make
    the root in the same way.

    ``order`` should end in a column that tells all rows apart, or rows equal in it take any of their places.  A group
    may hold all rows: it is sorted and pivoted by many tasks.  No rows give a null root.  Runs jobs.
    """
    if not 2 <= fanout <= MOST_COLUMNS:
        raise ValueError(f"fanout must be 2 to {MOST_COLUMNS}")
    groups = _climb(placed(leaves, order).select("g", "pos", "n", "node"), fanout, "manifest")
    subroots = keep(groups.tops.select("g", F.col("top").alias("subroot"), "stratum"), "subroots")
    named = subroots.select(F.lit(ONE_GROUP).alias("g"), F.col("g").alias("name"),
                            F.struct(F.col("subroot").alias("digest"), F.col("g").alias("name"), "stratum").alias("node"))
    over = _climb(placed(named, ["name"]).select("g", "pos", "n", "node"), fanout, "manifest-root")
    root = over.tops.first()
    return Manifest(groups, over, subroots.select("g", "subroot"), root["top"] if root else None)


def proofs(manifest: Manifest) -> DataFrame:
    """(g, node, proof, subroot, root) of each leaf; ``proof`` lists (before, after) from the leaf's run up to the root's."""
    none = F.array().cast("array<struct<before: string, after: string>>")
    top = manifest.over.tops.select("g", "stratum", none.alias("proof"), F.col("top").alias("subroot"))
    starts = _descend(manifest.over, top).select(
        F.col("node.name").alias("g"), F.col("node.stratum").alias("stratum"), "proof",
        F.col("node.digest").alias("subroot"))
    return _descend(manifest.groups, starts).withColumn("root", F.lit(manifest.root).cast("string"))


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda own, x: hashed(x["before"], own, x["after"]))


def verify(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
           claimed: Column | None = None, group: str = "lang", key: str = "doc_id", fanout: int = FANOUT) -> DataFrame:
    """Each row's leaf, place in the tree and proof, and whether ``claimed`` (a digest; null: the leaf) leads to the root.

    Returns the key, leaf, subroot, root, proof_sha256, folded_root and verified.  Leaves ascend by key inside their group, null
    first; rows of one key by their leaf, equal rows by their place in the input, so that a third of the rows may be
    copies of one.  Null groups are a group of their own, before the others; null values are hashed as ``-``.  Empty and
    very long texts are hashed whole.  No rows give no rows; other columns are not looked at.  Runs jobs.

    Texts are read once: leaves are written first, and only digests and keys are sorted.
    """
    leaf = leaf_digest(*[F.col(c) for c in columns])
    leaves = keep(docs.select(
        group_key(F.col(group)).alias("g"), F.col(key).alias("key"), leaf.alias("leaf"),
        (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
        F.monotonically_increasing_id().alias("at")), "leaves")
    rows = leaves.select("g", "key", "leaf", "at",
                         F.struct(F.col("leaf").alias("digest"), F.col("key"), F.col("claimed")).alias("node"))
    folded = fold(F.coalesce("node.claimed", "node.digest"), F.col("proof"))
    return proofs(build(rows, ["key", "leaf", "at"], fanout)).select(
        F.col("node.key").alias(key), F.col("node.digest").alias("leaf"), "subroot", "root",
        proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
