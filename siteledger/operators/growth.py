"""Naive versus comparable growth.

A unit counts as comparable only if it was open long enough at both ends of the
comparison and no conversion (a later code era) falls into either period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import growth_pct
from .metrics import in_range

Span = tuple[str, str]


def _months_before(day: Column, months: int) -> Column:
    return F.add_months(day, -months)


def _converted_units(eras: DataFrame, openings: DataFrame, unit: str,
                     valid_from: str) -> DataFrame:
    """Era starts that are conversions, i.e. later than the unit's first opening."""
    return eras.join(openings.select(unit, "open_date"), unit) \
        .filter(F.col(valid_from) > F.col("open_date")) \
        .select(unit, F.col(valid_from).alias("converted_on")).distinct()


def comparable_growth(monthly: DataFrame, openings: DataFrame, eras: DataFrame, unit: str,
                      value: str, month: str = "month_start", min_months_open: int = 13,
                      both_ends: bool = True, settle_months: int = 12,
                      valid_from: str = "valid_from") -> DataFrame:
    """Year-over-year growth by month over all units and over comparable units.

    ``monthly`` is unit x month, ``openings`` has (unit, open_date) and ``eras``
    (unit, ``valid_from``).  The base is the same calendar month a year earlier,
    found by an equi-join on the month, so a missing month is no base rather than
    a shifted one.  ``both_ends=False`` tests the opening at the current month only.
    """
    base = monthly.select(unit, F.add_months(month, 12).alias(month),
                          F.col(value).alias("base_value"))
    paired = monthly.select(unit, month, value).join(base, [unit, month]) \
        .filter(F.col("base_value").isNotNull())
    conversions = _converted_units(eras, openings, unit, valid_from)
    # An exclusion lasts from the conversion until a year after it has settled.
    closed = conversions.withColumn("_reopens", F.add_months("converted_on", settle_months + 12))
    inside = F.col(month).between(F.col("converted_on"), F.date_sub("_reopens", 1))
    touched = paired.select(unit, month).join(closed, unit).filter(inside) \
        .select(unit, month, F.lit(True).alias("_converting")).distinct()
    age = min_months_open + (12 if both_ends else 0)
    flagged = paired.join(openings.select(unit, "open_date"), unit) \
        .join(touched, [unit, month], "left") \
        .withColumn("comparable", (F.col("open_date") <= _months_before(F.col(month), age))
                    & F.col("_converting").isNull())
    only = F.col("comparable")
    return flagged.groupBy(month).agg(
        growth_pct(F.sum(value), F.sum("base_value")).alias("naive_yoy_pct"),
        growth_pct(F.sum(F.when(only, F.col(value))),
                   F.sum(F.when(only, F.col("base_value")))).alias("comp_yoy_pct"),
        F.count_if(only).alias("comp_units")) \
        .select(F.date_format(month, "yyyy-MM").alias("month"), "naive_yoy_pct",
                "comp_yoy_pct", "comp_units")


def two_period_growth(rows: DataFrame, openings: DataFrame, eras: DataFrame, unit: str,
                      day: str, value: str, now: Span, base: Span, min_months_open: int = 13,
                      both_ends: bool = True, valid_from: str = "valid_from") -> DataFrame:
    """One row: growth between two spans over all units and over comparable units.

    A unit is comparable if it opened early enough and has not been converted
    since the base span began.
    """
    sums = rows.filter(in_range(day, now) | in_range(day, base)).groupBy(unit).agg(
        F.sum(F.when(in_range(day, now), F.col(value))).alias("now_value"),
        F.sum(F.when(in_range(day, base), F.col(value))).alias("base_value"))
    anchor = F.lit(base[0] if both_ends else now[0]).cast("date")
    since = F.lit(base[0]).cast("date")
    converted = _converted_units(eras, openings, unit, valid_from) \
        .filter(F.col("converted_on") >= since) \
        .select(unit, F.lit(True).alias("_converting")).distinct()
    flagged = sums.join(openings.select(unit, "open_date"), unit) \
        .join(converted, unit, "left") \
        .withColumn("comparable", (F.col("open_date") <= F.add_months(anchor, -min_months_open))
                    & F.col("_converting").isNull())
    only = F.col("comparable")
    return flagged.agg(
        growth_pct(F.sum("now_value"), F.sum("base_value")).alias("naive_yoy_pct"),
        growth_pct(F.sum(F.when(only, F.col("now_value"))),
                   F.sum(F.when(only, F.col("base_value")))).alias("comp_yoy_pct"),
        F.count_if(only).alias("comp_units"))
