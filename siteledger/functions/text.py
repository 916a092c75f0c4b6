"""Text clean-up: blanks, code variants, labels, join keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: ColumnOrName) -> Column:
    """An empty field is a missing value, not a zero-length one."""
    return F.nullif(as_col(value), F.lit(""))


def normal_key(value: ColumnOrName) -> Column:
    """Case- and padding-insensitive join key for free text."""
    return F.lower(F.trim(as_col(value)))


def _lookup(key: Column, mapping: Mapping[str, str], default: Column) -> Column:
    result = None
    for variant, code in mapping.items():
        hit = key == F.lit(variant.strip().lower())
        result = F.when(hit, code) if result is None else result.when(hit, code)
    return default if result is None else result.otherwise(default)


def map_codes(value: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Replace known variants (any casing or padding); upper-case whatever is left."""
    return _lookup(normal_key(value), mapping, F.upper(F.trim(as_col(value))))


def title_case(value: ColumnOrName) -> Column:
    """Capitalise every run of letters or digits, whatever separates them.

    Spark's ``initcap`` starts a word after whitespace only, so labels with other
    separators are rebuilt run by run.
    """
    text = as_col(value)
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    rebuilt = F.array_join(F.transform(runs, lambda run: F.concat(
        F.upper(F.substring(run, 1, 1)), run.substr(F.lit(2), F.length(run)))), "")
    return F.when(text.rlike(r"[^\p{L}\p{N}\s]"), rebuilt).otherwise(F.initcap(text))


def title_label(value: ColumnOrName, exceptions: Mapping[str, str] | None = None) -> Column:
    """Title-case a label; ``exceptions`` maps any-case input to its fixed spelling."""
    return _lookup(normal_key(value), exceptions or {}, title_case(F.trim(as_col(value))))
