"""Cost ratios: against a target, between periods, and their price drivers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import growth_pct, iso_weekday, mean_of, month_start, pct
from .metrics import in_range, within

Span = tuple[str, str]


def period_totals(rows: DataFrame, unit: str, day: str, measures: Mapping[str, str],
                  grain: str = "month") -> DataFrame:
    """Sum measures to unit x period (``month`` or ``week``, weeks start on Monday)."""
    return rows.groupBy(unit, F.trunc(F.col(day), grain).alias(f"{grain}_start")) \
        .agg(*[F.sum(c).alias(out) for out, c in measures.items()])


def with_costs(net: DataFrame, costs: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left-join pre-aggregated cost series onto net; an absent cost counts zero.

    Every input is already at the grain of ``on``, so nothing fans out.
    """
    result = net
    for cost in costs:
        measures = [c for c in cost.columns if c not in on]
        result = result.join(cost, list(on), "left").fillna(0, measures)
    return result


def ratio_vs_target(totals: DataFrame, plan: DataFrame, unit: str, net: str,
                    costs: Sequence[str], plan_net: str, plan_costs: Sequence[str],
                    default_target: float, min_miss: float, month: str = "month_start"
                    ) -> DataFrame:
    """Unit-months whose cost ratio beats the target by more than ``min_miss`` points.

    Without a plan row the filter uses ``default_target`` while target and miss
    are reported as NULL; such rows sort first when ordered by miss descending
    with nulls first.
    """
    known = plan.select(unit, month, F.lit(True).alias("_planned"),
                        _total(plan_costs).alias("_plan_cost"),
                        F.col(plan_net).alias("_plan_net"))
    joined = totals.filter(F.col(net) > 0).join(known, [unit, month], "left")
    actual = pct(_total(costs), net, None)
    target = pct("_plan_cost", "_plan_net", None)
    return joined.withColumn("_actual", actual).withColumn("_target", target) \
        .filter(F.col("_actual") - F.coalesce("_target", F.lit(float(default_target)))
                > float(min_miss)) \
        .select(unit, F.date_format(month, "yyyy-MM").alias("month"),
                F.round("_actual", 2).alias("cost_pct"),
                F.round("_target", 2).alias("target_pct"),
                F.round(F.col("_actual") - F.col("_target"), 2).alias("miss_pts"),
                F.col("_planned").isNull().alias("no_plan_row"))


def _total(columns: Sequence[str]) -> Column:
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total


def over_plan(actual: DataFrame, plan: DataFrame, unit: str, cost: str, plan_cost: str,
              n: int, month: str = "month_start") -> DataFrame:
    """The n unit-months that overspent their plan the most, planned months only."""
    over = actual.join(plan.select(unit, month, plan_cost), [unit, month]) \
        .select(unit, month, (F.col(cost) - F.col(plan_cost)).alias("over_plan"))
    return over.orderBy(F.col("over_plan").desc_nulls_last(), unit, month).limit(n)


def _per_window(columns: Sequence[str], windows: Mapping[str, Span], day: str) -> list[Column]:
    return [F.sum(F.when(in_range(day, span), F.col(c))).alias(f"{name}_{c}")
            for name, span in windows.items() for c in columns]


def _any_window(windows: Mapping[str, Span], day: str) -> Column:
    hit = F.lit(False)
    for span in windows.values():
        hit = hit | in_range(day, span)
    return hit


def window_sums(rows: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str],
                windows: Mapping[str, Span]) -> DataFrame:
    """Sums per named date window as columns ``<window>_<column>``, in one pass.

    Conditional sums instead of a range join: no pairing of rows with windows,
    a date may lie in several windows, and the date filter reaches the scan.
    """
    return rows.filter(_any_window(windows, day)).groupBy(*keys) \
        .agg(*_per_window(columns, windows, day))


def ratio_in_windows(sums: DataFrame, unit: str, num: str, den: str, before: str,
                     after: str, scale: int = 2) -> DataFrame:
    """Ratio in two windows of ``window_sums`` output and its change in points."""
    first = pct(f"{before}_{num}", f"{before}_{den}", None)
    second = pct(f"{after}_{num}", f"{after}_{den}", None)
    paired = (F.col(f"{before}_{num}").isNotNull() & F.col(f"{before}_{den}").isNotNull()) \
        | (F.col(f"{after}_{num}").isNotNull() & F.col(f"{after}_{den}").isNotNull())
    return sums.filter(paired).select(
        unit, F.round(first, scale).alias(f"{num}_pct_{before}"),
        F.round(second, scale).alias(f"{num}_pct_{after}"),
        F.round(second - first, scale).alias("delta_pts"))


def cost_bridge(rows: DataFrame, day: str, net: str, labor: str, purchases: str,
                windows: Mapping[str, Span]) -> DataFrame:
    """Cost ratio of two windows split into legs, one output row per leg.

    ``windows`` names the baseline first, then the window compared with it.  One
    aggregate row holds every sum; ``stack`` turns it into the lines.
    """
    before, after = windows
    weekend = iso_weekday(day) >= 6
    base = rows.withColumn("_wk_net", F.when(weekend, F.col(net))) \
        .withColumn("_wk_labor", F.when(weekend, F.col(labor)))
    sums = window_sums(base, [], day, [net, labor, purchases, "_wk_net", "_wk_labor"], windows)

    def legs(w: str) -> list[Column]:
        n, lab, buy, wn, wl = (F.col(f"{w}_{c}") for c in
                               (net, labor, purchases, "_wk_net", "_wk_labor"))
        return [pct(lab + buy, n, None), pct(lab, n, None), pct(wl, wn, None),
                pct(lab - wl, n - wn, None), pct(buy, n, None)]

    labels = ["total cost, % of net", "labor leg", "labor leg, weekend", "labor leg, weekday",
              "purchases leg"]
    triples = [F.struct(F.lit(label).alias("line"), F.round(b, 2).alias(before),
                        F.round(a, 2).alias(after), F.round(a - b, 2).alias("delta_pts"))
               for label, b, a in zip(labels, legs(before), legs(after))]
    return sums.select(F.inline(F.array(*triples)))


def target_miss(rows: DataFrame, day: str, net: str, costs: Sequence[str], span: Span,
                target: float) -> DataFrame:
    """Cost ratio of one window, its miss against a target, and that miss in money."""
    sums = within(rows, day, span).agg(
        F.sum(net).alias("_net"), *[F.sum(c).alias(f"_{c}") for c in costs])
    cost_pct = pct(_total([f"_{c}" for c in costs]), "_net", None)
    miss = cost_pct - F.lit(float(target))
    return sums.select(
        F.round(cost_pct, 2).alias("cost_pct"), F.round(miss, 2).alias("miss_vs_target_pts"),
        F.round(F.col("_net").cast("double"), 0).alias("net_sales"),
        F.round(miss / 100.0 * F.col("_net").cast("double"), 0).alias("excess_cost"))


def price_steps(rows: DataFrame, keys: Sequence[str], day: str, price: str,
                min_move: float) -> DataFrame:
    """Months whose mean price moved by at least ``min_move`` from the previous observed month."""
    monthly = rows.groupBy(*keys, month_start(day).alias("month_start")) \
        .agg(F.round(mean_of(price), 4).cast("double").alias("avg_price"))
    previous = F.lag("avg_price").over(Window.partitionBy(*keys).orderBy("month_start"))
    # Move in units of the rounded ratio: 12 decimals hide double noise at the limit.
    move = F.round(F.col("avg_price") / F.col("prev_price") - 1.0, 12)
    return monthly.withColumn("prev_price", previous).filter("prev_price > 0") \
        .filter(F.abs(move) >= float(min_move)) \
        .select(*keys, F.date_format("month_start", "yyyy-MM").alias("step_month"),
                "prev_price", "avg_price",
                growth_pct("avg_price", "prev_price", 1).alias("step_pct"))


def mean_change(rows: DataFrame, day: str, value: str, month: str, base_month: str,
                scale: int = 1, out: str = "change_pct") -> DataFrame:
    """Percentage change of one mean between two months, as a single row."""
    first = F.lit(base_month).cast("date")
    second = F.lit(month).cast("date")
    inside = (F.col(day) >= F.least(first, second)) \
        & (F.col(day) <= F.last_day(F.greatest(first, second)))
    at = month_start(day)
    return rows.filter(inside).agg(growth_pct(
        mean_of(value, at == second), mean_of(value, at == first), scale).alias(out))
