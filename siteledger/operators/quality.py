"""Data checks.  Each returns the violations as a frame; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import pct
from .conform import unmapped_names
from .positions import positions


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return grain(df.filter(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values)) \
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def relationships(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no parent.

    Compares distinct values first, which combine map-side on both sides, so a
    value held by very many rows costs one row per task.  The orphaned values
    are few, usually none, and only they are matched back to the rows.
    """
    used = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("_ref")).distinct()
    known = parent.select(F.col(key).alias("_key")).distinct()
    orphans = used.join(known, F.col("_ref") == F.col("_key"), "left_anti")
    return df.join(orphans, F.col(column) == F.col("_ref"), "left_semi")


def expression_is_true(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is false; unknown passes, as a CHECK does."""
    holds = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~holds)


def map_total(df: DataFrame, name: str, aliases: DataFrame, alias: str = "alias") -> DataFrame:
    """Names the alias map does not cover."""
    return unmapped_names(df, name, aliases, alias)


def bounded_variance(books: DataFrame, max_days: int) -> DataFrame:
    """One row with the number of differing days when it exceeds the bound.

    ``books`` comes from ``reconcile.two_books``: a full outer join by default,
    so a day only one book knows about counts as well.
    """
    return books.filter(F.col("variance") != 0) \
        .agg(F.count(F.lit(1)).alias("variance_days")).filter(F.col("variance_days") > max_days)


def ratio_in_band(totals: DataFrame, keys: Sequence[str], net: str, costs: Sequence[str],
                  low: float, high: float) -> DataFrame:
    """Groups with positive net whose cost ratio lies outside [low, high] percent."""
    cost = F.col(costs[0])
    for c in costs[1:]:
        cost = cost + F.col(c)
    actual = pct(cost, net, None)
    return totals.filter(F.col(net) > 0).filter(~actual.between(float(low), float(high))) \
        .select(*keys, F.round(actual, 2).alias("cost_pct"))


def conservation(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Row-count change across a join that should neither drop nor fan out rows."""
    tagged = before.select(*keys, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(*keys, F.lit(0).alias("b"), F.lit(1).alias("a")))
    return tagged.groupBy(*keys).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_after")).filter("rows_before <> rows_after")


def metric_bands(metrics: DataFrame, bands: Mapping[str, tuple[float | None, float | None]],
                 metric: str = "metric", value: str = "value") -> DataFrame:
    """Metrics outside their band, or missing although a band names them.

    ``metrics`` is long (metric, value); a bound of None is open.
    """
    spark = metrics.sparkSession
    limits = spark.createDataFrame(
        [(m, None if lo is None else float(lo), None if hi is None else float(hi))
         for m, (lo, hi) in bands.items()], "metric string, low double, high double")
    seen = metrics.select(F.col(metric).alias("metric"), F.col(value).cast("double").alias("value"))
    inside = (F.col("low").isNull() | (F.col("value") >= F.col("low"))) \
        & (F.col("high").isNull() | (F.col("value") <= F.col("high")))
    return limits.join(seen, "metric", "left").filter(F.col("value").isNull() | ~inside) \
        .select("metric", "value", "low", "high")


def _cell(df: DataFrame, field: T.StructField, scale: int) -> Column:
    """Comparable text of one cell: stripped text, numbers half-even to ``scale``; a number too large
    for that, and NaN or infinity, is compared by its own text."""
    value = df[field.name]
    kind = field.dataType
    if isinstance(kind, T.BooleanType):
        return F.concat(F.lit("bool:"), value.cast("string"))
    if isinstance(kind, T.NumericType):
        exact = value.try_cast("decimal(38,12)")
        fixed = F.bround(exact, scale).try_cast(f"decimal(38,{scale})")
        return F.coalesce(fixed.cast("string"), value.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.replace(value.cast("string"), F.lit(" "), F.lit("T"))
    return F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", "")


def diff_results(expected: DataFrame, actual: DataFrame, scale: int = 2,
                 expected_order: Sequence[Column | str] | None = None,
                 actual_order: Sequence[Column | str] | None = None) -> DataFrame:
    """Rows on which two result sets differ; empty means equivalent.

    Columns compare by position, names are ignored; text is trimmed, numbers are
    rounded half-even to ``scale``, NULL equals NULL, and duplicates count.  Row
    order matters only when both sort orders are given.  Cells become text
    arrays, so results of different width differ without special treatment.
    """
    if (expected_order is None) != (actual_order is None):
        raise ValueError("give both sort orders or neither")
    if expected_order is not None:
        left = positions(expected, expected_order)
        right = positions(actual, actual_order)
        place = ["position"]
    else:
        left, right, place = expected, actual, []

    def side(df: DataFrame, original: DataFrame, sign: int) -> DataFrame:
        cells = F.array(*[_cell(df, f, scale) for f in original.schema.fields])
        return df.select(*place, cells.alias("cells"), F.lit(sign).alias("_sign"))

    both = side(left, expected, 1).unionByName(side(right, actual, -1))
    return both.groupBy(*place, "cells").agg(F.sum("_sign").alias("surplus")) \
        .filter("surplus <> 0") \
        .select(*place, F.when(F.col("surplus") > 0, "expected").otherwise("actual").alias("only_in"),
                F.abs("surplus").alias("copies"), "cells")


def all_non_empty(results: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the results that have no row, found in one job."""
    probes = None
    for name, df in results.items():
        probe = df.limit(1).agg(F.count(F.lit(1)).alias("n")) \
            .select(F.lit(name).alias("query"), "n")
        probes = probe if probes is None else probes.unionByName(probe)
    if probes is None:
        raise ValueError("no results given")
    return probes.filter("n = 0").select("query")
