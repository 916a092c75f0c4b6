"""Amounts and ratios.

Amounts stay decimal so that sums are exact in any order; a ratio casts both
exact sums to double, divides once and rounds once.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, as_col


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; NULL when the denominator is zero or missing."""
    return as_col(num).cast("double") / F.nullif(as_col(den).cast("double"), F.lit(0.0))


def pct(num: ColumnOrName, den: ColumnOrName, scale: int | None = 2) -> Column:
    value = F.lit(100.0) * as_col(num).cast("double") \
        / F.nullif(as_col(den).cast("double"), F.lit(0.0))
    return value if scale is None else F.round(value, scale)


def growth_pct(now: ColumnOrName, base: ColumnOrName, scale: int | None = 2) -> Column:
    value = F.lit(100.0) * (ratio(now, base) - F.lit(1.0))
    return value if scale is None else F.round(value, scale)


def mean_of(value: ColumnOrName, where: Column | None = None) -> Column:
    """Mean as exact sum over count (aggregate expression); a decimal stays decimal.

    Rounding a decimal mean is exact at the half, which a double mean is not.
    """
    value = as_col(value) if where is None else F.when(where, as_col(value))
    return F.sum(value) / F.nullif(F.count(value), F.lit(0))


def backfill_ratio(target: ColumnOrName, num: ColumnOrName, den: ColumnOrName,
                   scale: int = 4) -> Column:
    """``target`` where known, else num / den rounded; the target itself is untouched."""
    derived = F.round(as_col(num) / F.nullif(as_col(den), F.lit(0)), scale)
    return F.coalesce(as_col(target), derived)


def signed_net(state: ColumnOrName, qty: ColumnOrName, price: ColumnOrName,
               discount: ColumnOrName, dtype: str = "decimal(11,2)") -> Column:
    """Net amount by line state.

    A refund line already carries a negative quantity, so it is only multiplied;
    discounts apply to sales only; every other state (void, comp) counts zero.
    """
    value = as_col(qty) * as_col(price)
    return F.when(as_col(state) == "sale", (value - as_col(discount)).cast(dtype)) \
        .when(as_col(state) == "refund", value.cast(dtype)) \
        .otherwise(F.lit(0).cast(dtype))
