"""Two-book reconciliation and the cost of re-sent rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import pct


def duplicate_impact(keyed: DataFrame, unit: str, month: str) -> DataFrame:
    """What copies would have added, per unit-month.

    ``keyed`` has one row per business key with ``copies``, ``all_value`` (summed
    over all copies), ``kept_value`` (the newest copy's) and ``net`` (what the
    newest copy counts for).  Excess is all minus kept, so the copies themselves
    are never ranked or moved; the month's net enters the denominator once.
    """
    sums = keyed.groupBy(unit, month).agg(
        F.sum(F.col("copies") - 1).alias("duplicate_lines"),
        (F.coalesce(F.sum("all_value"), F.lit(0))
         - F.coalesce(F.sum("kept_value"), F.lit(0))).alias("inflated_net"),
        F.sum("net").alias("_net"))
    return sums.filter("duplicate_lines > 0").select(
        unit, month, "duplicate_lines", "inflated_net",
        pct("inflated_net", "_net", 3).alias("inflation_pct"))


def two_books(left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str,
              right_value: str, how: str = "full_outer") -> DataFrame:
    """Both books side by side; a missing side counts zero under an outer join."""
    return left.select(*on, F.col(left_value).alias("book_a")) \
        .join(right.select(*on, F.col(right_value).alias("book_b")), list(on), how) \
        .fillna(0, ["book_a", "book_b"]) \
        .withColumn("variance", F.col("book_b") - F.col("book_a"))


def tie_out_exceptions(books: DataFrame, unit: str, day: str, rounding: float = 5,
                       detect_shift: bool = False) -> DataFrame:
    """Days that do not tie, bucketed by the shape of the difference.

    A zero or absent second book against positive sales is ``b_missing_day``; that
    also catches days whose amount was booked a day later.  With
    ``detect_shift`` such a pair (a shortfall that the next day carries in full)
    is named ``shifted`` instead.
    """
    bucket = F.when((F.col("book_b") == 0) & (F.col("book_a") > 0), "b_missing_day") \
        .when(F.abs("variance") <= rounding, "rounding") \
        .when(F.col("variance") < 0, "b_under_a").otherwise("b_over_a")
    open_items = books.filter(F.col("variance") != 0)
    if detect_shift:
        carried = open_items.select(unit, F.date_sub(day, 1).alias(day),
                                    F.col("variance").alias("_next"))
        received = open_items.select(unit, F.date_add(day, 1).alias(day),
                                     F.col("variance").alias("_prev"))
        open_items = open_items.join(carried, [unit, day], "left") \
            .join(received, [unit, day], "left")
        gave = (F.col("variance") < 0) & (F.col("_next") == -F.col("variance"))
        took = (F.col("variance") > 0) & (F.col("_prev") == -F.col("variance"))
        bucket = F.when(F.coalesce(gave, F.lit(False)) | F.coalesce(took, F.lit(False)),
                        "shifted").otherwise(bucket)
    return open_items.select(unit, day, "book_a", "book_b", "variance", bucket.alias("bucket"))


def tied_days(books: DataFrame, unit: str) -> DataFrame:
    """Tied and differing days per unit."""
    return books.groupBy(unit).agg(
        F.count_if(F.col("variance") == 0).alias("tied_days"),
        F.count_if(F.col("variance") != 0).alias("variance_days"))
