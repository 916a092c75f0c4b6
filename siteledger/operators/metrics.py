"""Sales metrics by unit and period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import growth_pct, month_start, pct


def sum_where(value: str, where: Column) -> Column:
    return F.sum(F.when(where, F.col(value)))


def ticket_rollup(lines: DataFrame, ticket: Sequence[str],
                  totals: Mapping[str, Column] | None = None,
                  flags: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per ticket: summed measures and any-line flags.

    Done before header attributes are joined on, it shrinks the row count ahead
    of the join and turns a later distinct-ticket count into a plain count.
    """
    return lines.groupBy(*ticket).agg(
        *[F.sum(v).alias(k) for k, v in (totals or {}).items()],
        *[F.bool_or(v).alias(k) for k, v in (flags or {}).items()])


def monthly_net(rows: DataFrame, unit: str, day: str, net: str, flagged: Column,
                tickets: Column) -> DataFrame:
    """Net sales, flagged gross and ticket count per unit and calendar month.

    ``tickets`` is the aggregate that counts tickets: a distinct count over
    lines, or a plain count when ``rows`` are tickets already.
    """
    return rows.groupBy(unit, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(net).alias("net_sales"), F.sum(flagged).alias("comp_gross"),
        tickets.alias("tickets"))


def rate_exceptions(rows: DataFrame, unit: str, day: str, part: Column, whole: Column,
                    min_rate: float) -> DataFrame:
    """Unit-months where sum(part) exceeds ``min_rate`` of sum(whole)."""
    sums = rows.groupBy(unit, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(part).alias("comp_gross"), F.sum(whole).alias("whole"))
    over = F.col("comp_gross") > F.lit(str(min_rate)).cast("decimal(9,6)") * F.col("whole")
    return sums.filter(over).select(
        unit, "year", "month", pct("comp_gross", "whole").alias("comp_rate_pct"), "comp_gross")


def share_of_tickets(tickets: DataFrame, unit: str, flag: str, scale: int = 1,
                     out: str = "share_pct") -> DataFrame:
    """Percentage of a unit's tickets that carry a flag (rows are tickets)."""
    return tickets.groupBy(unit).agg(
        pct(F.count_if(F.col(flag)), F.count(F.lit(1)), scale).alias(out))


def share_within(rows: DataFrame, keys: Sequence[str], value: str, where: Column,
                 scale: int = 1, out: str = "share_pct") -> DataFrame:
    """Part of each group's total that meets a condition, in percent."""
    return rows.groupBy(*keys).agg(
        pct(sum_where(value, where), F.sum(value), scale).alias(out))


def share_of_total(rows: DataFrame, key: str, value: str, scale: int = 1,
                   out: str = "share_pct") -> DataFrame:
    """Each key's share of the grand total.

    The total is a scalar subquery over the same aggregate, which Spark runs once
    and reuses; an empty-partition window would pull every key into one task.
    """
    sums = rows.groupBy(key).agg(F.sum(value).alias("_value"))
    total = sums.agg(F.sum("_value")).scalar()
    return sums.select(key, pct(F.col("_value"), total, scale).alias(out))


def period_growth(rows: DataFrame, unit: str, day: str, value: str,
                  now: tuple[str, str], base: tuple[str, str], scale: int = 1,
                  out: str = "growth_pct") -> DataFrame:
    """Growth between two date ranges per unit, NULL where the base is zero or absent."""
    return rows.groupBy(unit).agg(growth_pct(
        sum_where(value, F.col(day).between(*_dates(now))),
        sum_where(value, F.col(day).between(*_dates(base))), scale).alias(out))


def _dates(span: tuple[str, str]) -> tuple[Column, Column]:
    return F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")


def in_range(day: str, span: tuple[str, str]) -> Column:
    """Inclusive date range as a pushable predicate."""
    return F.col(day).between(*_dates(span))


def within(rows: DataFrame, day: str, span: tuple[str, str],
           partition: str = "month_start") -> DataFrame:
    """Rows of an inclusive date range, also pruning month partitions where there are any."""
    kept = rows.filter(in_range(day, span))
    if partition in rows.columns and partition != day:
        first, last = _dates(span)
        kept = kept.filter(F.col(partition).between(F.trunc(first, "month"), last))
    return kept


def vs_group_mean(rows: DataFrame, unit: str, day: str, value: str,
                  months: Sequence[str]) -> DataFrame:
    """Unit-months against the mean of all units in the same month."""
    lower, upper = min(months), max(months)
    month = month_start(day)
    wanted = [F.lit(m).cast("date") for m in months]
    # The plain range reaches the scan; the exact months are checked after it.
    near = rows.filter((F.col(day) >= F.lit(lower).cast("date"))
                       & (F.col(day) <= F.last_day(F.lit(upper).cast("date"))))
    monthly = near.filter(month.isin(*wanted)).groupBy(unit, month.alias("_month")) \
        .agg(F.sum(value).alias("net_sales"))
    group = monthly.groupBy("_month").agg(
        (F.sum("net_sales").cast("double") / F.count("net_sales")).alias("group_avg"))
    return monthly.join(group, "_month").select(
        unit, F.date_format("_month", "yyyy-MM").alias("month"),
        F.round(F.col("net_sales").cast("double"), 0).alias("net_sales"),
        F.round("group_avg", 0).alias("group_avg_per_unit"),
        growth_pct("net_sales", "group_avg", 1).alias("vs_group_pct"))


def run_rate(rows: DataFrame, unit: str, day: str, net: str, days_per_year: int = 365
             ) -> DataFrame:
    """Annualised net per open day, by unit and year."""
    sums = rows.groupBy(unit, F.year(day).alias("year")).agg(
        F.sum(net).alias("net_sales"), F.count_distinct(F.col(day)).alias("open_days"))
    return sums.withColumn("annualized_net", F.round(
        F.col("net_sales").cast("double") / F.col("open_days") * days_per_year, 2))


def highest_rates(rows: DataFrame, unit: str, day: str, part: Column, whole: Column,
                  n: int = 4) -> DataFrame:
    """The n unit-months with the highest part/whole rate, among those with whole > 0."""
    sums = rows.groupBy(unit, month_start(day).alias("month_start")).agg(
        F.sum(part).alias("part"), F.sum(whole).alias("whole")).filter("whole > 0")
    rate = pct("part", "whole", None)
    return sums.orderBy(rate.desc_nulls_last(), unit, "month_start").limit(n).select(
        unit, F.date_format("month_start", "yyyy-MM").alias("month"),
        F.round(rate, 1).alias("rate_pct"))


def top_n(rows: DataFrame, key: str, value: str, n: int, out: str = "units") -> DataFrame:
    """The n keys with the largest sum; ties go to the smaller key."""
    return rows.groupBy(key).agg(F.sum(value).alias(out)) \
        .orderBy(F.col(out).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(n)
