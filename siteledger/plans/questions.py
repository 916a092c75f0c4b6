"""The question bank on the bound tables: short reports, one function per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import mean_of, month_start, pct, ratio
from ..operators import calendar, costs, metrics, mix, reconcile
from ..operators.metrics import in_range
from . import bindings as b
from .analyses import attach_tickets, both_books, flag_tickets, plain, unit_prices
from .conforming import order_days

YEAR_96, YEAR_97, YEAR_98 = ((f"{y}-01-01", f"{y}-12-31") for y in (1996, 1997, 1998))
ONE_UNIT = "NATION_5"
TWELVE_MONTHS = ("2000-07-01", "2001-06-30")


def q01_count_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.units(spark, sf_dir).filter("area = 'ASIA'").agg(F.count(F.lit(1)).alias("units"))


def q02_list_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.units(spark, sf_dir).filter("area = 'EUROPE'").select("unit", "unit_id")


def q03_item_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(b.parts(spark, sf_dir).filter("part = 25").select("price"))


def q04_count_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.parts(spark, sf_dir).filter("category = 'MEDIUM'").agg(F.count(F.lit(1)).alias("items"))


def q05_total_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(b.ticket_sales(spark, sf_dir, YEAR_97).agg(F.sum("net").alias("net_sales")))


def q06_suppliers_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = b.units(spark, sf_dir).filter("unit = 'NATION_3'")
    return b.table(spark, sf_dir, "supplier").join(
        home, F.col("s_nationkey") == F.col("unit_id"), "left_semi").select("s_name")


def q07_items_without_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.parts(spark, sf_dir).filter("unit_cost is null").select("part", "item_name")


def q08_net_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, YEAR_97)
    return plain(rows.groupBy("area").agg(F.round(F.sum("net"), 2).alias("net_sales"))
                 .orderBy(F.desc("net_sales"), "area"))


def q09_average_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, YEAR_97)
    return rows.groupBy("unit").agg(
        F.round(ratio(F.sum("net"), F.count(F.lit(1))), 2).alias("average_ticket"))


def q10_best_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.sales(spark, sf_dir, YEAR_96).filter("state = 'sale'")
    return metrics.top_n(rows, "part", "qty", 5)


def q11_unit_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, YEAR_97, ONE_UNIT)
    return plain(rows.groupBy(month_start("day").alias("month"))
                 .agg(F.sum("net").alias("net_sales")).orderBy("month"))


def q12_flagged_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of tickets with any large line, whatever its state."""
    tickets = flag_tickets(spark, sf_dir, {"large": F.abs("qty") >= 45}, span=YEAR_97)
    return metrics.share_of_tickets(tickets, "unit", "large", 1, "large_pct")


def q13_comp_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, YEAR_97) \
        .filter(F.col("comp_gross").isNotNull())
    return plain(rows.groupBy("unit").agg(F.round(F.sum("comp_gross"), 2).alias("comp_value")))


def q14_over_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, YEAR_97)
    actual = costs.period_totals(rows, "unit", "day", {"labor": "labor"})
    over = costs.over_plan(actual, b.plan_rows(spark, sf_dir), "unit", "labor", "plan_labor", 5)
    return over.withColumn("over_plan", F.round(F.col("over_plan"), 2).cast("double"))


def q15_weekend_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar.describe_days(order_days(spark, sf_dir), "day") \
        .select(F.col("date_key").alias("day"), "is_weekend")
    rows = b.ticket_sales(spark, sf_dir, YEAR_97) \
        .groupBy("unit", "day").agg(F.sum("net").alias("net")).join(days, "day")
    return metrics.share_within(rows, ["unit"], "net", F.col("is_weekend"), 1, "weekend_pct")


def q16_top_three_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.sales(spark, sf_dir, ("1997-10-01", "1997-12-31")) \
        .filter("state = 'sale'")
    return mix.top_per_group(rows, ["unit"], "part", "qty", 3).select("unit", "part", "units")


def q17_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.period_growth(b.ticket_sales(spark, sf_dir, (YEAR_97[0], YEAR_98[1])),
                                 "unit", "day", "net", YEAR_98, YEAR_97)


def q18_differing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = both_books(spark, sf_dir, "inner", YEAR_98)
    return reconcile.tied_days(books, "unit").select("unit", "variance_days")


def q19_ratio_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the tickets of the range, summed by unit."""
    rows = b.ticket_costs(spark, sf_dir, TWELVE_MONTHS)
    sums = rows.groupBy("unit").agg(*[F.sum(c).alias(c) for c in ("net", "labor", "purchases")])
    return sums.select(
        "unit", pct(F.col("purchases") + F.col("labor"), "net").alias("cost_pct")) \
        .orderBy(F.desc("cost_pct"), "unit")


def q20_attach_half_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = attach_tickets(spark, sf_dir, span=("2000-01-01", "2000-06-30"))
    return metrics.share_of_tickets(tickets.filter("has_sale"), "unit", "attached", 1, "attach_pct")


def q21_share_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    era = F.when(F.col("day") < F.lit(b.ERA_SPLIT).cast("date"), "before").otherwise("after")
    rows = b.headers(spark, sf_dir).filter(F.col("unit") == ONE_UNIT).withColumn("era", era)
    return metrics.share_within(rows, ["era"], "order_value", F.col("priority") == "1-URGENT",
                                1, "urgent_pct")


def q22_mean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    may = in_range("day", ("1998-05-01", "1998-05-31"))
    july = in_range("day", ("1998-07-01", "1998-07-31"))
    rows = unit_prices(spark, sf_dir, ("1998-05-01", "1998-07-31")) \
        .filter("brand = 'Brand#7'").filter("state = 'sale'").filter(may | july)
    return plain(rows.groupBy(F.date_format("day", "yyyy-MM").alias("month"))
                 .agg(F.round(mean_of("unit_price"), 2).alias("mean_price")))


def q23_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.lines_only(spark, sf_dir).select("supplier", "list_value")
    return metrics.share_of_total(rows, "supplier", "list_value")


def q24_mean_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unit_prices(spark, sf_dir, ("1998-02-01", "1998-03-31")) \
        .filter("brand = 'Brand#7'")
    return costs.mean_change(rows, "day", "unit_price", "1998-03-01", "1998-02-01")


QUESTIONS = {f.__name__: f for f in (
    q01_count_units, q02_list_units, q03_item_price, q04_count_items, q05_total_net,
    q06_suppliers_of, q07_items_without_cost, q08_net_by_area, q09_average_ticket,
    q10_best_sellers, q11_unit_months, q12_flagged_tickets, q13_comp_value, q14_over_plan,
    q15_weekend_share, q16_top_three_quarter, q17_growth, q18_differing_days, q19_ratio_ranking,
    q20_attach_half_year, q21_share_before_after, q22_mean_price, q23_share_of_total,
    q24_mean_change)}
