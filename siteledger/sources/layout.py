"""Physical layout beyond partitions: interleaved clustering, Bloom filters, column statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bits of each column in the interleaved sort key.
BITS = 16


def _ordinal(df: DataFrame, column: str) -> Column:
    """The column as a whole number that keeps its order."""
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_seconds(F.col(column).cast("timestamp"))
    if kind in ("byte", "short", "integer", "long"):
        return F.col(column).cast("bigint")
    raise ValueError(f"{column} is {kind}; dates, times and whole numbers can be interleaved")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Z-order value: the bits of the columns, each scaled to its own range, taken in turn from the highest.

    Rows near each other in this order are near in every column.  NULL counts as the smallest.  Runs a job (the ranges).
    """
    if not 1 <= len(columns) * bits <= 62:
        raise ValueError("at most 62 bits in all")
    ordinals = {c: _ordinal(df, c) for c in columns}
    ends = df.agg(*[f(v).alias(f"{name}_{c}") for c, v in ordinals.items() for name, f in (("lo", F.min), ("hi", F.max))]).first()
    parts = []
    for k, (c, value) in enumerate(ordinals.items()):
        lo, hi = ends[f"lo_{c}"] or 0, ends[f"hi_{c}"] or 0
        scaled = F.coalesce(F.floor((value - lo) / float(hi - lo + 1) * (1 << bits)), F.lit(0)).cast("bigint")
        parts += [F.shiftleft(F.shiftright(scaled, i).bitwiseAND(F.lit(1).cast("bigint")), i * len(columns) + len(columns) - 1 - k)
                  for i in range(bits)]
    return reduce(Column.bitwiseOR, parts)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bloom: Sequence[str] = (),
                    bloom_values: int = 1_000_000, row_group_bytes: int = 128 << 20) -> None:
    """Write a table so that a filter on any one of ``columns`` leaves few files and row groups.

    Rows are range-partitioned and sorted by the interleaved bits of the columns, so a frequent value is spread by the
    other columns.  Equality on a ``bloom`` column is also asked of a Bloom filter in each row group, sized
    for ``bloom_values`` different values.
    """
    ordered = df.withColumn("_z", interleaved(df, columns)).repartitionByRange(files, "_z") \
        .sortWithinPartitions("_z", *columns).drop("_z")
    writer = ordered.write.mode("overwrite").option("parquet.block.size", str(row_group_bytes))
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true") \
            .option(f"parquet.bloom.filter.expected.ndv#{column}", str(bloom_values))
    writer.parquet(path)


def analyze_columns(spark: SparkSession, table: str, columns: Sequence[str], histograms: bool = True) -> None:
    """Column statistics for the planner's row estimates and join order."""
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(histograms).lower())
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    finally:
        spark.conf.set(setting, before)


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct, nulls, least, greatest, histogram) as the catalog holds them; distinct counts are estimates."""
    rows = []
    for column in columns:
        stats = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        known = {k: v for k, v in stats.items() if v not in (None, "NULL")}
        rows.append((column, int(known.get("distinct_count", 0)), int(known.get("num_nulls", 0)), known.get("min"),
                     known.get("max"), any("bin" in (k or "") or k == "histogram" for k in known)))
    return spark.createDataFrame(rows, "column string, n_distinct bigint, nulls bigint, least string, greatest string, "
                                       "histogram boolean")
