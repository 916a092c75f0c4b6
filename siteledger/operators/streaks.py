"""Consecutive-week streaks above a cost-ratio threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import pct
from .costs import _total


def rolling_flags(weekly: DataFrame, unit: str, net: str, costs: Sequence[str],
                  threshold: float, weeks: int = 4, week: str = "week_start") -> DataFrame:
    """Flag each week whose rolling cost ratio exceeds the threshold.

    The frame counts observed weeks; weeks before it is full, and windows whose
    net is not positive, give no row.  Input is unit x week, so a window
    partition holds one row per week of one unit.
    """
    frame = Window.partitionBy(unit).orderBy(week).rowsBetween(1 - weeks, 0)
    rolled = weekly.select(
        unit, week, F.sum(net).over(frame).alias("_net"),
        F.sum(_total(costs)).over(frame).alias("_cost"),
        F.count(F.lit(1)).over(frame).alias("_weeks"))
    return rolled.filter((F.col("_weeks") == weeks) & (F.col("_net") > 0)) \
        .select(unit, week, (pct("_cost", "_net", None) > float(threshold)).alias("over"))


def streaks(flags: DataFrame, unit: str, flag: str = "over", week: str = "week_start",
            min_weeks: int = 4, consecutive: str = "calendar") -> DataFrame:
    """Runs of flagged weeks at least ``min_weeks`` long.

    ``calendar``: weeks are consecutive if they are seven days apart, so an
    absent week ends a run.  ``observed``: consecutive among the weeks that have
    a row at all, so only an unflagged week ends a run; the numbering therefore
    has to happen before the unflagged weeks are dropped.
    """
    by_week = Window.partitionBy(unit).orderBy(week)
    if consecutive == "calendar":
        runs = flags.filter(F.col(flag)) \
            .withColumn("_run", F.date_sub(week, F.row_number().over(by_week) * 7))
    elif consecutive == "observed":
        by_flag = Window.partitionBy(unit, flag).orderBy(week)
        runs = flags.withColumn("_run", F.row_number().over(by_week)
                                - F.row_number().over(by_flag)).filter(F.col(flag))
    else:
        raise ValueError(f"consecutive must be 'calendar' or 'observed', not {consecutive!r}")
    return runs.groupBy(unit, "_run").agg(
        F.min(week).alias("streak_start"), F.max(week).alias("streak_end"),
        F.count(F.lit(1)).alias("weeks")).filter(F.col("weeks") >= min_weeks).drop("_run")
