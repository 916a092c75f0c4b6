"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from .bands import band, hour_in, weekday_window_flag
from .dates import (DATE_FORMATS, iso_weekday, month_label, month_start, parse_dates,
                    to_local_ntz, week_start)
from .money import backfill_ratio, growth_pct, mean_of, pct, ratio, signed_net
from .text import blank_to_null, map_codes, normal_key, title_case, title_label

__all__ = [
    "DATE_FORMATS", "backfill_ratio", "band", "blank_to_null", "growth_pct", "hour_in",
    "iso_weekday", "map_codes", "mean_of", "month_label", "month_start", "normal_key",
    "parse_dates", "pct", "ratio", "signed_net", "title_case", "title_label",
    "to_local_ntz", "week_start", "weekday_window_flag",
]
