"""Data checks on the bound tables.  They return violations, so rows here are findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import costs, growth, metrics, quality, streaks
from ..operators.conform import resolve_alias
from ..sources.landing import pin
from . import analyses as a, bindings as b
from .analyses import plain

# The bands the metrics must lie in.
METRIC_BANDS = {"miss_pts": (4.0, 4.6), "longest_streak": (20.0, None),
                "streak_dominance": (2.5, None), "growth_spread": (0.5, None),
                "attach_gap": (8.0, None)}


def t01_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets that have a header but no line."""
    sums = b.line_items(spark, sf_dir).groupBy("ticket").agg(F.sum("net").alias("net"))
    tickets = b.headers(spark, sf_dir).join(sums, "ticket", "left")
    return quality.not_null(tickets, "net").select("ticket", "unit")


def t02_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(b.table(spark, sf_dir, "part"), "p_name")


def t03_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(b.table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"])


def t04_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships(b.table(spark, sf_dir, "orders"), "o_orderkey",
                                 b.table(spark, sf_dir, "lineitem"), "l_orderkey") \
        .select("o_orderkey", "o_custkey")


def t05_expression_is_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The net rule holds by construction; a non-negative net does not (refunds)."""
    lines = b.line_items(spark, sf_dir)
    broken = quality.expression_is_true(
        lines, "state <> 'sale' or net = cast(gross - discount as decimal(18,4))")
    negative = quality.expression_is_true(lines, "net >= 0")
    return plain(broken.unionByName(negative).select("ticket", "line", "net"))


def t06_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grain(b.table(spark, sf_dir, "lineitem"), list(b.LINE_KEY))


def t07_map_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.map_total(b.raw_names(spark, sf_dir), "keyed_name", b.aliases(spark, sf_dir))


def t08_bounded_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bounded_variance(a.both_books(spark, sf_dir), 45)


def t09_ratio_in_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = costs.period_totals(b.ticket_costs(spark, sf_dir), "unit", "day",
                                 {"net": "net", "labor": "labor", "purchases": "purchases"})
    return quality.ratio_in_band(totals, ["unit", "month_start"], "net",
                                 ["purchases", "labor"], 30.0, 60.0)


def t09_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per item lost by the inner join with the alias map."""
    names = b.raw_names(spark, sf_dir)
    resolved = resolve_alias(names, "keyed_name", b.aliases(spark, sf_dir).drop("item_name"))
    return quality.conservation(names, resolved, ["item_name"])


def t10_metric_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics from one table of units and days, written once; each is an aggregate of few rows."""
    days = pin(b.unit_days(spark, sf_dir, "PROMO"), "unit-days")[0]
    own_unit = F.col("unit") == a.BRIDGE_UNIT
    miss = costs.target_miss(days.filter(own_unit), "day", "net", ["labor", "purchases"], a.BRIDGE_WINDOWS["trailing"], 35.0) \
        .select(F.lit("miss_pts").alias("metric"), F.col("miss_vs_target_pts").alias("value"))
    weekly = costs.period_totals(days.filter(F.col("net").isNotNull()), "area", "day",
                                 {"net": "net", "labor": "labor", "purchases": "purchases"}, grain="week")
    flags = streaks.rolling_flags(weekly, "area", "net", ["purchases", "labor"], a.STREAK_THRESHOLD)
    asia = F.col("area") == "ASIA"
    longest = streaks.streaks(flags, "area").agg(
        F.max(F.when(asia, F.col("weeks"))).cast("double").alias("own"),
        F.max(F.when(~asia, F.col("weeks"))).cast("double").alias("other"))
    streak = longest.select(F.inline(F.array(
        F.struct(F.lit("longest_streak").alias("metric"), F.col("own").alias("value")),
        F.struct(F.lit("streak_dominance").alias("metric"),
                 F.round(F.col("own") / F.col("other"), 4).alias("value")))))
    opened = days.groupBy("unit").agg(F.trunc(F.min("day"), "month").alias("open_date"))
    spread = growth.two_period_growth(
        days, opened, b.unit_eras(spark, sf_dir), "unit", "day", "order_value", *a.GROWTH_SPANS).select(
        F.lit("growth_spread").alias("metric"),
        F.round(F.col("naive_yoy_pct") - F.col("comp_yoy_pct"), 2).alias("value"))
    attach = days.agg(
        metrics.pct(F.sum("attached_tickets"), F.sum("sale_tickets"), None).alias("everyone"),
        metrics.pct(F.sum(F.when(own_unit, F.col("attached_tickets"))), F.sum(F.when(own_unit, F.col("sale_tickets"))), None)
        .alias("own"))
    gap = attach.select(F.lit("attach_gap").alias("metric"),
                        F.round(F.col("everyone") - F.col("own"), 2).alias("value"))
    found = miss.unionByName(streak).unionByName(spread).unionByName(gap)
    return quality.metric_bands(found, METRIC_BANDS)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.headers(spark, sf_dir).groupBy("unit", "day").agg(
        F.sum("order_value").alias("value"), F.count(F.lit(1)).alias("orders"))


def t11_diff_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy with a visible change on one weekday, an invisible one on another, padded names."""
    expected = _order_days(spark, sf_dir)
    change = F.when(F.weekday("day") == 0, F.lit("1.00")).when(F.weekday("day") == 1, F.lit("0.004")) \
        .otherwise(F.lit("0")).cast("decimal(20,4)")
    actual = expected.select(F.concat("unit", F.lit(" ")).alias("place"), "day",
                             (F.col("value") + change).alias("amount"), "orders")
    found = quality.diff_results(expected, actual)
    return found.withColumn("cells", F.array_join("cells", "|"))


def t11_diff_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, ranked by value and by name: most stand in different places."""
    totals = b.headers(spark, sf_dir).groupBy("unit").agg(F.sum("order_value").alias("value"))
    found = quality.diff_results(totals, totals, expected_order=[F.desc("value"), "unit"],
                                 actual_order=["unit"])
    return found.withColumn("cells", F.array_join("cells", "|"))


def t12_all_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = b.units(spark, sf_dir)
    return quality.all_non_empty({
        "units": unit,
        "units_nowhere": unit.filter("area = 'ATLANTIS'"),
        "items_without_cost": b.parts(spark, sf_dir).filter("unit_cost is null"),
        "items_without_price": b.parts(spark, sf_dir).filter("price is null"),
        "comps": b.line_items(spark, sf_dir).filter("state = 'comp'"),
    })


CHECKS = {f.__name__: f for f in (
    t01_not_null, t02_unique, t03_accepted_values, t04_relationships, t05_expression_is_true,
    t06_grain, t07_map_total, t08_bounded_variance, t09_ratio_in_band, t09_conservation,
    t10_metric_bands, t11_diff_results, t11_diff_ordered, t12_all_non_empty)}
