"""Calendar dimension: typing an existing one, or building one from a date range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import blank_to_null, iso_weekday
from .cleaning import cast_columns

CALENDAR_TYPES = {
    "year": "smallint", "quarter": "smallint", "month": "smallint", "day_of_week": "smallint",
    "is_weekend": "boolean", "is_holiday": "boolean", "is_school_break": "boolean",
    "is_dining_week": "boolean", "is_marathon_sunday": "boolean",
}


def typed_calendar(raw: DataFrame) -> DataFrame:
    """All-text calendar to the typed date dimension; blank holiday labels and an unknown recess become NULL."""
    named = raw.withColumn("date_day", F.col("date_day").cast("date")) \
        .withColumn("holiday_name", blank_to_null("holiday_name")) \
        .withColumn("holiday_type", blank_to_null("holiday_type")) \
        .withColumn("is_school_break", blank_to_null("is_school_break"))
    return cast_columns(named, CALENDAR_TYPES).withColumnRenamed("date_day", "date_key")


def nth_weekday(day: Column, month: int, weekday: int, nth: int) -> Column:
    """Is ``day`` the nth ISO weekday (1 = Monday) of the month?"""
    return (F.month(day) == month) & (iso_weekday(day) == weekday) \
        & F.dayofmonth(day).between(7 * nth - 6, 7 * nth)


def last_weekday(day: Column, month: int, weekday: int) -> Column:
    """Is ``day`` the last such weekday of the month, so that a week later is another month?"""
    return (F.month(day) == month) & (iso_weekday(day) == weekday) \
        & (F.month(F.date_add(day, 7)) != month)


def fixed_day(day: Column, month: int, dom: int) -> Column:
    return (F.month(day) == month) & (F.dayofmonth(day) == dom)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Gauss's rule with its two exceptions, in integer arithmetic.

    ``m`` and ``n`` carry the century corrections; (d, e) locate the Sunday after
    the paschal full moon as 22 March + d + e.
    """
    century = (year / 100).cast("int")
    p = ((century * 8 + 13) / 25).cast("int")
    q = (century / 4).cast("int")
    m = (F.lit(15) - p + century - q) % 30
    n = (F.lit(4) + century - q) % 7
    cycle = year % 19
    d = (cycle * 19 + m) % 30
    e = ((year % 4) * 2 + (year % 7) * 4 + d * 6 + n) % 7
    late = ((d == 29) & (e == 6)) | ((d == 28) & (e == 6) & (((m * 11 + 11) % 30) < 19))
    offset = d + e - F.when(late, 7).otherwise(0)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), offset)


def holiday_rules(day: Column) -> list[tuple[str, str, Column]]:
    """(name, type, is-it-that-day); an earlier entry wins when two fall on one day."""
    # Holiday names, types and the rule that dates each one.
    return [
        ("Marathon Sunday", "city_event", nth_weekday(day, 11, 7, 1)),
        ("Super Bowl Sunday", "observance", nth_weekday(day, 2, 7, 2)),
        ("New Year's Eve", "observance", fixed_day(day, 12, 31)),
        ("Thanksgiving Eve", "observance", nth_weekday(F.date_add(day, 1), 11, 4, 4)),
        ("Halloween", "observance", fixed_day(day, 10, 31)),
        ("Father's Day", "observance", nth_weekday(day, 6, 7, 3)),
        ("Mother's Day", "observance", nth_weekday(day, 5, 7, 2)),
        ("Easter Sunday", "observance", day == easter_sunday(F.year(day))),
        ("Valentine's Day", "observance", fixed_day(day, 2, 14)),
        ("Christmas Day", "federal", fixed_day(day, 12, 25)),
        ("Thanksgiving", "federal", nth_weekday(day, 11, 4, 4)),
        ("Veterans Day", "federal", fixed_day(day, 11, 11)),
        ("Columbus Day", "federal", nth_weekday(day, 10, 1, 2)),
        ("Labor Day", "federal", nth_weekday(day, 9, 1, 1)),
        ("Independence Day", "federal", fixed_day(day, 7, 4)),
        ("Juneteenth", "federal", fixed_day(day, 6, 19)),
        ("Memorial Day", "federal", last_weekday(day, 5, 1)),
        ("Washington's Birthday", "federal", nth_weekday(day, 2, 1, 3)),
        ("MLK Day", "federal", nth_weekday(day, 1, 1, 3)),
        ("New Year's Day", "federal", fixed_day(day, 1, 1)),
    ]


def midwinter_recess(day: Column) -> Column:
    """Monday to Friday of the week that opens with the third Monday of February."""
    back_to_monday = F.date_sub(day, iso_weekday(day) - 1)
    return nth_weekday(back_to_monday, 2, 1, 3) & (iso_weekday(day) <= 5)


# Yearly windows as ((month, day), (month, day)), both ends inside.
SUMMER_BREAK = ((6, 27), (9, 5))
DINING_WEEKS = (((1, 16), (1, 31)), ((7, 22), (8, 8)))
# Spring recess has no rule, it is announced year by year.
SPRING_BREAKS = (
    ("2024-04-22", "2024-04-30"),
    ("2025-04-14", "2025-04-18"),
    ("2026-03-30", "2026-04-03"),
)


def _yearly(day: Column, window: tuple[tuple[int, int], tuple[int, int]]) -> Column:
    (m1, d1), (m2, d2) = window
    return (F.month(day) * 100 + F.dayofmonth(day)).between(m1 * 100 + d1, m2 * 100 + d2)


def _dated(day: Column, windows: Sequence[tuple[str, str]]) -> Column:
    hit = F.lit(False)
    for first, last in windows:
        hit = hit | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return hit


def build_calendar(spark: SparkSession, start: str, end: str,
                   spring_breaks: Sequence[tuple[str, str]] = SPRING_BREAKS,
                   extra_flags: Mapping[str, Sequence[tuple[str, str]]] | None = None
                   ) -> DataFrame:
    """One typed row per day from ``start`` to ``end``.

    ``extra_flags`` adds boolean columns, each true inside any of its date windows.
    """
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_key"))
    return describe_days(days, "date_key", spring_breaks, extra_flags)


def describe_days(days: DataFrame, date_key: str = "date_key",
                  spring_breaks: Sequence[tuple[str, str]] = SPRING_BREAKS,
                  extra_flags: Mapping[str, Sequence[tuple[str, str]]] | None = None
                  ) -> DataFrame:
    """Calendar attributes for a frame of distinct days.

    ``is_school_break`` is NULL on days that only the spring recess could make one, in years for
    which ``spring_breaks`` has no dates.
    """
    day = F.col(date_key)
    name, kind = None, None
    for label, label_type, hit in holiday_rules(day):
        name = F.when(hit, label) if name is None else name.when(hit, label)
        kind = F.when(hit, label_type) if kind is None else kind.when(hit, label_type)
    dining = F.lit(False)
    for window in DINING_WEEKS:
        dining = dining | _yearly(day, window)
    announced = sorted({int(edge[:4]) for window in spring_breaks for edge in window})
    # A year without announced dates is unknown where nothing else says yes.
    spring = F.when(F.year(day).isin(announced), _dated(day, spring_breaks))
    school = midwinter_recess(day) | _yearly(day, SUMMER_BREAK) | spring
    flags = [_dated(day, windows).alias(flag) for flag, windows in (extra_flags or {}).items()]
    return days.select(
        day.alias("date_key"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        iso_weekday(day).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
        name.isNotNull().alias("is_holiday"),
        name.alias("holiday_name"),
        kind.alias("holiday_type"),
        school.alias("is_school_break"),
        dining.alias("is_dining_week"),
        nth_weekday(day, 11, 7, 1).alias("is_marathon_sunday"),
        *flags,
    )
