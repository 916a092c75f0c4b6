"""Dates and local time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, as_col

# The three export formats, (pattern the text must match, Spark format).
DATE_FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
)


def _iso_text(text: Column, fmt: str) -> Column | None:
    """The text as a cast to date reads it, for the formats of ``DATE_FORMATS``: a cast takes a tenth of a formatter's time.

    The ``T`` ends the day, so that a line break behind it is no date, as for a formatter.
    """
    if fmt == "yyyy-MM-dd":
        return F.concat(text, F.lit("T"))
    if fmt == "yyyy/MM/dd":
        return F.concat(F.translate(text, "/", "-"), F.lit("T"))
    if fmt == "M/d/yyyy":
        month_day = F.substring(text, F.lit(1), F.length(text) - F.lit(5))
        return F.translate(F.concat(F.right(text, F.lit(4)), F.lit("/"), month_day, F.lit("T")), "/", "-")
    return None


def parse_dates(value: ColumnOrName, formats: Sequence[tuple[str, str]] = DATE_FORMATS,
                strict: bool = True) -> Column:
    """Parse text with the first format whose pattern matches; no match gives NULL.

    A text that matches a pattern but is no real date (month 13) fails the job
    when ``strict``, else becomes NULL.
    """
    text = as_col(value)
    result = None
    for pattern, fmt in formats:
        hit = text.rlike(pattern)
        iso = _iso_text(text, fmt) if (pattern, fmt) in DATE_FORMATS else None
        if iso is None:
            parsed = F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)
        else:
            parsed = iso.cast("date") if strict else iso.try_cast("date")
        result = F.when(hit, parsed) if result is None else result.when(hit, parsed)
    if result is None:
        raise ValueError("parse_dates needs at least one format")
    return result


def to_local_ntz(value: ColumnOrName, tz: str) -> Column:
    """Wall-clock time in ``tz``: a trailing ``Z`` marks UTC, anything else is already local."""
    text = as_col(value)
    utc = F.substring(text, F.lit(1), F.length(text) - F.lit(1)).cast("timestamp_ntz")
    return F.when(text.endswith("Z"), F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)) \
        .otherwise(text.cast("timestamp_ntz"))


def month_start(day: ColumnOrName) -> Column:
    return F.trunc(as_col(day), "month")


def week_start(day: ColumnOrName) -> Column:
    """Monday of the ISO week."""
    return F.trunc(as_col(day), "week")


def month_label(day: ColumnOrName) -> Column:
    return F.date_format(as_col(day), "yyyy-MM")


def iso_weekday(day: ColumnOrName) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(as_col(day)) + F.lit(1)
