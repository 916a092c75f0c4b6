"""Writing layers: full refresh with counts, views and tables, fact layout, samples."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..session import shared_dir
from .layout import analyze_columns
from .raw import read_raw
from .versions import Audit, audited, discard, swap_folders


# Row groups of intermediates: a writer holds one in memory for each open file.
PINNED_GROUP = 32 << 20


def land(df: DataFrame, path: str, row_group_bytes: int | None = None) -> int:
    """Overwrite ``path`` with the frame and return its row count.

    The count is observed by the same job that writes, so it costs no second
    scan; running it again gives the same table.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return int(seen.get["n"])


def pin(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write a frame that several branches share and read it back, with its row count.

    Runs a job.  The copy lives in the session's shared folder, so losing an
    executor loses nothing, and its size is known to the planner afterwards.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    n_rows = land(df, path, PINNED_GROUP)
    return spark.read.schema(df.schema).parquet(path), n_rows


def land_all(spark: SparkSession, feeds: Mapping[str, tuple[str, Sequence[str]]],
             target: str) -> DataFrame:
    """Land CSV feeds ``name -> (path, columns)``; one row per table with its count.

    All feeds are written beside the tables before the first table is replaced, so a missing file or a bad row in any
    of them leaves the whole previous load untouched.
    """
    frames = {name: read_raw(spark, path, columns) for name, (path, columns) in feeds.items()}
    staged = f"{target}/_staged-{uuid.uuid4().hex}"
    try:
        counts = [(name, land(df, f"{staged}/{name}")) for name, df in frames.items()]
        swap_folders(spark, staged, target, list(frames))
    finally:
        discard(spark, staged)
    return spark.createDataFrame(counts, "table string, n_rows bigint")


def publish(df: DataFrame, layer: str, name: str, kind: str = "view", audit: Audit | None = None) -> str:
    """Staging becomes a view ``layer__name``, a mart a table ``layer.name``.

    A table is written under another name, audited, and only then takes the place of the old one, so that a failure
    leaves the old one as it was.
    """
    spark = df.sparkSession
    if kind == "view":
        view = f"{layer}__{name}"
        df.createOrReplaceTempView(view)
        return view
    if kind != "table":
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    fresh = f"{layer}.{name}__{uuid.uuid4().hex}"
    df.write.saveAsTable(fresh)
    try:
        audited({name: spark.table(fresh)}, audit)
    except ValueError:
        spark.sql(f"DROP TABLE {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {layer}.{name}")
    return f"{layer}.{name}"


def sample_extract(df: DataFrame, order: Sequence[Column | str], n: int = 500) -> DataFrame:
    """The first n rows in an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def write_fact(df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str],
               table: str | None = None, buckets: int | None = None, bucket_cols: Sequence[str] = (),
               column_statistics: Sequence[str] = ()) -> None:
    """Write a fact partitioned by ``partition_col`` and clustered inside.

    Rows are range-partitioned by partition and cluster columns together: each
    task writes few partitions, and a partition that holds a large part of the
    rows is spread over several tasks.  With ``table`` the fact is registered
    and its statistics are computed for the planner, with histograms for the ``column_statistics``.

    With ``buckets`` rows are instead dealt by a hash of ``bucket_cols`` and sorted by them, one file for each partition
    and bucket, so that grouping and joining on these columns (or more) needs no shuffle afterwards.
    """
    spark = df.sparkSession
    if buckets is None:
        laid_out = df.repartitionByRange(F.col(partition_col), *[F.col(c) for c in cluster_cols]) \
            .sortWithinPartitions(partition_col, *cluster_cols)
    elif table is None or not bucket_cols:
        raise ValueError("a bucketed fact needs a table and bucket columns")
    else:
        laid_out = df.repartition(buckets, *bucket_cols).sortWithinPartitions(partition_col, *bucket_cols)
    writer = laid_out.write.mode("overwrite").partitionBy(partition_col)
    if table is None:
        writer.parquet(path)
        return
    if buckets is not None:
        writer = writer.bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
    writer.option("path", path).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if column_statistics:
        analyze_columns(spark, table, column_statistics)
