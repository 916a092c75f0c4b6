"""Hour bands and weekday windows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from .dates import iso_weekday
from .text import ColumnOrName, as_col


def hour_in(hour: Column, first: int, last: int) -> Column:
    """Hour between ``first`` and ``last`` inclusive, wrapping midnight when first > last."""
    if first <= last:
        return hour.between(first, last)
    return (hour >= first) | (hour <= last)


def band(ts: ColumnOrName, bands: Sequence[tuple[str, int, int]], default: str) -> Column:
    """Name the band ``(label, first hour, last hour)`` a timestamp falls in.

    Both hours are inclusive, so a band covers its last hour to the end.  NULL
    and uncovered hours take ``default``.
    """
    hour = F.hour(as_col(ts))
    result = None
    for label, first, last in bands:
        hit = hour_in(hour, first, last)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return F.lit(default) if result is None else result.otherwise(default)


def weekday_window_flag(day: ColumnOrName, ts: ColumnOrName, weekdays: Iterable[int],
                        first: int, last: int) -> Column:
    """True on the given ISO weekdays between two inclusive hours."""
    return iso_weekday(day).isin(*weekdays) & hour_in(F.hour(as_col(ts)), first, last)
