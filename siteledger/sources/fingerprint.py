"""Order-independent table fingerprints and manifests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def canonical_row(df: DataFrame) -> Column:
    """One text per row: every cell with its length, and NULL as a mark of its own, in column order."""
    cells = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
             for text in (F.col(f"`{c}`").cast("string") for c in df.columns)]
    return F.concat_ws("|", *cells)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (n_rows, digest); equal for equal contents in any order or partitioning.

    The digest is two sums of 60-bit pieces of each row's MD5 in decimal(38,0): they neither overflow nor
    depend on the order of the additions, and combine map-side.  The same cells in other columns, a
    NULL moved or a column added give another digest.
    """
    hashed = df.select(F.md5(canonical_row(df).cast("binary")).alias("h"))
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", start, 15), 16, 10).cast("decimal(38,0)")), F.lit(0))
            .cast("decimal(38,0)").cast("string") for start in (1, 16)]
    return hashed.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", *sums).alias("digest"))


def schema_text(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its fingerprint and its schema."""
    result = None
    for name in sorted(tables):
        row = fingerprint(tables[name]).select(
            F.lit(name).alias("table"), F.lit(schema_text(tables[name])).alias("schema"), "n_rows", "digest")
        result = row if result is None else result.unionByName(row)
    if result is None:
        raise ValueError("no tables given")
    return result


def verify(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Problems against a stored manifest; empty means verified."""
    want = expected.select("table", F.col("n_rows").alias("want_rows"),
                           F.col("digest").alias("want_digest"),
                           F.col("schema").alias("want_schema"))
    got = manifest(tables)
    joined = got.join(want, "table", "full_outer")
    problem = F.when(F.col("want_rows").isNull(), "not in manifest") \
        .when(F.col("n_rows").isNull(), "table missing") \
        .when(F.col("schema") != F.col("want_schema"), "schema differs") \
        .when((F.col("n_rows") != F.col("want_rows"))
              | (F.col("digest") != F.col("want_digest")), "contents differ")
    return joined.select("table", problem.alias("problem")).filter("problem is not null")
