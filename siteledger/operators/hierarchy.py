"""Rolling leaf values up a parent-child hierarchy of any depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.landing import pin


def rollup_levels(rows: DataFrame, levels: Sequence[str], value: str, root: str = "group"
                  ) -> DataFrame:
    """Total and number of leaves under every node of a fixed-depth hierarchy.

    ``levels`` are columns from leaf to top; every row also counts for ``root``.
    Rows are summed to leaves first, so only leaves are repeated per level.
    """
    leaves = rows.groupBy(*levels).agg(F.sum(value).alias("net_sales"))
    path = F.array(*[F.col(c) for c in levels], F.lit(root))
    return leaves.select(F.explode(path).alias("node"), "net_sales", F.col(levels[0]).alias("_leaf")) \
        .groupBy("node").agg(F.sum("net_sales").alias("net_sales"),
                             F.count_distinct(F.col("_leaf")).alias("leaves"))


def ancestors(nodes: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Closure (descendant, ancestor), every node being its own ancestor; any depth.

    Doubling: with all ancestors up to distance 2^k and the jumps of exactly 2^k, one join
    each gives those for k + 1, so a chain of n nodes takes log2(n) rounds.  Each round is
    pinned (a job).  Jumps that are still there when 2^k exceeds the number of nodes
    mean a cycle, which is an error.
    """
    links, n_links = pin(nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
                         .filter("node is not null and parent is not null"), "links")
    known = nodes.select(F.col(node).alias("descendant"), F.col(node).alias("ancestor")).filter("ancestor is not null")
    jumps, n_jumps, reach = links.select("node", F.col("parent").alias("far")), n_links, 1
    while n_jumps:
        if reach > n_links:
            raise ValueError("the hierarchy has a cycle")
        further = jumps.join(known.withColumnRenamed("descendant", "far"), "far") \
            .select(F.col("node").alias("descendant"), "ancestor")
        known, _ = pin(known.unionByName(further), "ancestors")
        onward = jumps.select(F.col("node").alias("far"), F.col("far").alias("farther"))
        jumps, n_jumps = pin(jumps.join(onward, "far").select("node", F.col("farther").alias("far")), "jumps")
        reach *= 2
    return known


def rollup_tree(leaves: DataFrame, leaf: str, value: str, nodes: DataFrame,
                node: str = "node", parent: str = "parent") -> DataFrame:
    """Total and number of leaves under every node, leaves included.

    Leaf rows are first summed to their direct parent, so the closure and
    its join only ever see inner nodes, however many leaves there are.  Those
    nodes are pinned (a job) because every round reads them again.
    """
    sums = leaves.groupBy(F.col(leaf).alias("node")).agg(F.sum(value).alias("net_sales"))
    tree = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
    placed = sums.join(tree, "node")
    inner, _ = pin(tree.join(tree.filter("parent is not null").select(
        F.col("parent").alias("node")).distinct(), "node", "left_semi"), "inner-nodes")
    by_parent = placed.filter("parent is not null").groupBy("parent").agg(
        F.sum("net_sales").alias("net_sales"), F.count(F.lit(1)).alias("leaves"))
    above = by_parent.join(ancestors(inner), F.col("parent") == F.col("descendant")) \
        .select(F.col("ancestor").alias("node"), "net_sales", "leaves")
    own = placed.select("node", "net_sales", F.lit(1).cast("bigint").alias("leaves"))
    return own.unionByName(above).groupBy("node").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("leaves").alias("leaves"))
