"""Digest trees: fingerprints of partitions, combined upward, that name what changed and reread only that."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .fingerprint import canonical_row

SUMS = ("d1", "d2")


def _piece(start: int) -> Column:
    return F.conv(F.substring("_h", start, 15), 16, 10).cast("decimal(38,0)")


def _marks() -> list[Column]:
    """The files of a partition as one number: path, size and time of each, counted once."""
    file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return [file.alias("_file")]


def partition_digests(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, n_rows, d1, d2: the fingerprint of each partition as two sums that add up to that of any union.

    The partition columns are part of each row's text.  Sums combine before the shuffle, so a partition that holds
    most of the rows is one row for each task.
    """
    hashed = df.select(*by, F.md5(canonical_row(df).cast("binary")).alias("_h"))
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.sum(_piece(start)).cast("decimal(38,0)").alias(name) for name, start in zip(SUMS, (1, 16), strict=True)])


def tree_digest(digests: DataFrame, by: Sequence[str]) -> DataFrame:
    """All nodes of the tree: ``level`` (0 for the table, then one for each column of ``by``), ``by``, n_rows, d1, d2.

    A node is the sum of its children, so the table's node equals its plain fingerprint.
    """
    def total(name: str) -> Column:
        kind = "decimal(38,0)" if name in SUMS else "bigint"
        return F.coalesce(F.sum(name), F.lit(0)).cast(kind).alias(name)

    nodes = [digests.groupBy(*by[:k]).agg(*[total(n) for n in ("n_rows", *SUMS)])
             .select(F.lit(k).alias("level"), *by[:k], *[F.lit(None).cast(digests.schema[c].dataType).alias(c) for c in by[k:]],
                     "n_rows", *SUMS) for k in range(len(by) + 1)]
    return reduce(DataFrame.unionByName, nodes)


def changed(tree: DataFrame, stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partitions that differ from a stored tree, with the problem; only below nodes that differ themselves."""
    def at(nodes: DataFrame, level: int, mark: str) -> DataFrame:
        return nodes.filter(F.col("level") == level).select(
            *[F.col(c).alias(f"_{mark}_{c}") for c in by[:level]],
            F.struct("n_rows", *SUMS).alias(f"_{mark}"))

    open_nodes, result = None, None
    for level in range(len(by) + 1):
        new, old = at(tree, level, "new"), at(stored, level, "old")
        keys = by[:level]
        same = reduce(Column.__and__, [F.col(f"_new_{c}").eqNullSafe(F.col(f"_old_{c}")) for c in keys], F.lit(True))
        both = new.join(old, same, "full_outer").filter(~F.col("_new").eqNullSafe(F.col("_old"))).select(
            *[F.coalesce(f"_new_{c}", f"_old_{c}").alias(c) for c in keys],
            F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "missing")
            .otherwise("contents differ").alias("problem"))
        if open_nodes is not None and by[:level - 1]:
            above = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in by[:level - 1]])
            both = both.join(open_nodes.select(*[F.col(c).alias(f"_up_{c}") for c in by[:level - 1]]), above, "left_semi")
        open_nodes = result = both
    return result


def file_marks(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and ``files``: what files a partition consists of.  Reads no column of the data but the partition's."""
    return df.select(*by, *_marks()).distinct().groupBy(*by).agg(
        F.sum(F.col("_file").cast("decimal(38,0)")).alias("files"))


def verify_partitions(df: DataFrame, by: Sequence[str], stored: DataFrame) -> DataFrame:
    """The digests of ``df`` now, rereading only partitions whose files are not those that ``stored`` saw.

    ``df`` is read from files partitioned by ``by``; ``stored`` has ``by``, files, n_rows, d1, d2, as this returns them, and may be
    empty.  The semi-join on the partition columns prunes the scan to the new partitions.
    """
    marks = file_marks(df, by)
    known = stored.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("files").alias("_files"), "n_rows", *SUMS)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]) & (F.col("files") == F.col("_files"))
    kept = marks.join(known, same).select(*by, "files", "n_rows", *SUMS)
    fresh = marks.join(known, same, "left_anti")
    wanted = fresh.select(*[F.col(c).alias(f"_{c}") for c in by])
    here = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    read = partition_digests(df.join(wanted, here, "left_semi"), by)
    named = read.withColumnsRenamed({c: f"_{c}" for c in by})
    return kept.unionByName(fresh.join(named, here).select(*by, "files", "n_rows", *SUMS))
