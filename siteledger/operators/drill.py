"""Drilling across facts: several facts of different grain stacked to one, with every period present."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# Steps between the periods of a spine.
STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTHS"}


@dataclass(frozen=True)
class Fact:
    """A fact's rows, its own date column, and its measures by their common names."""

    rows: DataFrame
    day: str
    measures: Mapping[str, Column | str]


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stack(facts: Sequence[Fact], keys: Sequence[str]) -> DataFrame:
    """All facts' rows under each other: ``keys``, ``day`` and every measure, NULL where a fact has none.

    Sums over the stack are sums over each fact by itself, so nothing fans out, facts need no common rows, and one
    shuffle serves them all.  A filter on keys or day reaches every fact's scan.
    """
    names = [name for fact in facts for name in fact.measures]
    if len(set(names)) != len(names):
        raise ValueError(f"measures must have different names: {names}")
    parts = [fact.rows.select(*keys, F.col(fact.day).cast("date").alias("day"),
                              *[_column(c).alias(name) for name, c in fact.measures.items()]) for fact in facts]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def fill_periods(totals: DataFrame, keys: Sequence[str], measures: Sequence[str], grain: str) -> DataFrame:
    """Every period between a group's first and last one; absent periods and absent measures are zero.

    A period row opens into itself and the absent ones up to its successor, so the spine needs neither a calendar nor a
    join.  The window holds one row for each period of one group.
    """
    start = f"{grain}_start"
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    step = F.expr(STEPS[grain])
    last = F.coalesce((following - step).cast("date"), F.col(start))
    opened = totals.withColumn("_last", last).withColumn("_period", F.explode(F.sequence(start, "_last", step)))
    own = F.col("_period") == F.col(start)
    return opened.select(*keys, F.col("_period").cast("date").alias(start), *[
        F.when(own, F.coalesce(F.col(m), F.lit(0))).otherwise(F.lit(0)).cast(totals.schema[m].dataType).alias(m)
        for m in measures])


def drill_across(facts: Sequence[Fact], keys: Sequence[str], grain: str = "month", dense: bool = True) -> DataFrame:
    """Measures of several facts by ``keys`` and period, each fact summed by itself.

    A period that any fact has is there; with ``dense`` also those between that none has.  Absent measures count zero.
    Rows without a date belong to no period.
    """
    measures = [name for fact in facts for name in fact.measures]
    start = f"{grain}_start"
    # Rows without a date go as a group: a filter on the day would be pushed below joins and ranks, where what makes the day
    # from text is worked out several times for every row.
    totals = stack(facts, keys).groupBy(*keys, (F.col("day") if grain == "day" else F.trunc("day", grain)).alias(start)).agg(
        *[F.sum(m).alias(m) for m in measures], F.count("day").alias("_dated")).filter("_dated > 0").drop("_dated")
    return fill_periods(totals, keys, measures, grain) if dense else totals.fillna(0, measures)
