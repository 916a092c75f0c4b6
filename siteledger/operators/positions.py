"""Row numbers in a sort order, spread over tasks however large a group is."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir


def positions(df: DataFrame, order: Sequence[Column | str], within: Sequence[str] = (),
              out: str = "position") -> DataFrame:
    """Number rows 1..n in sort order, over everything or within each group.

    A range-partitioned sort splits large groups over tasks.  The sorted rows are
    checkpointed (an action), which pins their partitions; a row's number is its
    distance from its group's first row in the same partition, plus the sizes of
    the group's pieces in earlier partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    pinned = df.orderBy(*within, *order) \
        .select("*", F.monotonically_increasing_id().alias("_id")).checkpoint() \
        .withColumn("_part", F.shiftright("_id", 33))
    piece = [*within, "_part"]
    sizes = pinned.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    # One row per group and sort partition, never one per data row.
    earlier = F.sum("_n").over(Window.partitionBy(*within).orderBy("_part")) - F.col("_n")
    offsets = sizes.select(*[F.col(c).alias(f"_key_{c}") for c in piece], "_first",
                           earlier.alias("_before"))
    match = reduce(lambda a, b: a & b,
                   [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in piece])
    place = F.col("_id") - F.col("_first") + F.col("_before") + F.lit(1)
    return pinned.join(offsets, match).select(*df.columns, place.alias(out))
