"""The twelve raw text feeds, rendered from the source tables.

Amounts that are sums are scaled down so that they fit the feeds' declared
types at any data size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import conform
from ..operators.cleaning import keep_latest
from ..sources import RAW_FEEDS
from . import bindings as b
from .conforming import calendar_text, date_text, label_text

# Service bands with inclusive end minute, the last one past midnight.
DAYPARTS = [("breakfast", "07:00", "10:59"), ("lunch", "11:00", "14:59"),
            ("afternoon", "15:00", "16:59"), ("dinner", "17:00", "21:59"),
            ("late_night", "22:00", "01:59")]
# Roles, and spellings of the units of measure as suppliers write them.
ROLES = ["Manager", "Line Cook", "Prep Cook", "Server", "Busser"]
UNITS_OF_MEASURE = ["case", "CASE ", "lb", "LB", " ea", "bag", "GAL", "keg"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(value: Column, dtype: str) -> Column:
    return value.cast(dtype).cast("string")


def coded_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket headers under the location code valid on their day."""
    eras = b.unit_eras(spark, sf_dir).select("unit", "location_code", "valid_from", "valid_to")
    return conform.in_era(b.headers(spark, sf_dir), eras, "unit", "day")


def _clock(day: Column, hour: Column, minute: Column, second: Column, micro: Column, utc: Column) -> Column:
    two = [F.lpad(part.cast("string"), 2, "0") for part in (hour, minute, second)]
    clock = F.concat(F.concat_ws(":", *two), F.lit("."), F.lpad(micro.cast("string"), 6, "0"))
    date = F.date_format(day, "yyyy-MM-dd")
    return F.when(utc, F.concat(date, F.lit("T"), clock, F.lit("Z"))) \
        .otherwise(F.concat(date, F.lit(" "), clock))


def _exports(spark: SparkSession, sf_dir: str, heads: DataFrame | None) -> DataFrame:
    """Raw lines, of the tickets of ``heads`` only if given: the ticket is part of a line's key, so others can go before all else."""
    lines = b.table(spark, sf_dir, "lineitem")
    return lines if heads is None else lines.join(heads.select(F.col("ticket").alias("l_orderkey")), "l_orderkey", "left_semi")


def ticket_lines(spark: SparkSession, sf_dir: str, heads: DataFrame | None = None) -> DataFrame:
    """Every export of every line, copies included."""
    lines = _exports(spark, sf_dir, heads).select(
        F.col("l_orderkey").alias("ticket"), "l_linenumber", F.col("l_partkey").alias("part"),
        "l_suppkey", F.col("l_quantity").cast("int").alias("pieces"), "l_discount", "l_shipdate",
        b.state_of().alias("state"))
    names = b.raw_names(spark, sf_dir).select("part", "keyed_name") \
        .join(b.parts(spark, sf_dir).select("part", "price"), "part")
    heads = (coded_headers(spark, sf_dir) if heads is None else heads).select("ticket", "day", "location_code")
    rows = lines.join(names, "part").join(heads, "ticket")
    ticket = F.col("ticket")
    discount = F.col("pieces") * F.col("price") * F.col("l_discount").cast(b.RATE)
    sign = F.when(F.col("state") == "refund", -1).otherwise(1)
    return rows.select(
        "location_code", date_text(F.col("day"), ticket).alias("business_date"),
        ticket.cast("string").alias("ticket_number"),
        F.col("l_linenumber").cast("string").alias("line_number"),
        _clock(F.col("l_shipdate").cast("date"), F.col("part") % 24, F.col("l_suppkey") % 60,
               ticket % 60, F.col("part") * 37 % 1_000_000, ticket % 4 == 0).alias("closed_at"),
        F.col("keyed_name").alias("item_name"),
        (sign * F.col("pieces")).cast("string").alias("qty"),
        _text(F.col("price"), "decimal(9,2)").alias("unit_price"),
        _text(discount, "decimal(9,2)").alias("discount_amount"),
        F.col("state").alias("line_state"),
        _pick(["DI", "TO", "DL"], ticket % 3).alias("order_mode"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit_id = F.col("unit_id")
    return b.places(spark, sf_dir).select(
        "location_code", F.concat(F.lit("Store "), F.col("unit")).alias("location_name"),
        F.col("unit").alias("neighborhood"), F.col("area").alias("borough"), "service_format",
        F.concat(F.lit("T"), (unit_id % 4 + 1).cast("string")).alias("volume_tier"),
        (unit_id % 80 + 20).cast("string").alias("seats"),
        F.col("open_date").cast("string").alias("open_date"),
        F.coalesce(F.col("closed_date").cast("string"), F.lit("")).alias("closed_date"))


def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = b.parts(spark, sf_dir).groupBy("item_name").agg(
        F.min("part").alias("id"), F.min("category").alias("category"),
        F.min("price").alias("price"))
    cost = F.when(F.col("id") % 29 == 0, "").otherwise(
        _text(F.col("price") * F.lit("0.3").cast("decimal(2,1)"), "decimal(7,4)"))
    return names.select(
        F.col("id").cast("string").alias("menu_item_id"), "item_name",
        label_text(F.initcap("category"), F.col("id")).alias("category"),
        _text(F.col("price"), "decimal(7,2)").alias("standard_price"),
        cost.alias("theoretical_unit_cost"))


def invoice_lines(spark: SparkSession, sf_dir: str, heads: DataFrame | None = None) -> DataFrame:
    """One invoice per order; of the copies of a line the newest one counts."""
    worth = F.col("l_extendedprice").cast(b.MONEY)
    newest = keep_latest(_exports(spark, sf_dir, heads), b.LINE_KEY, b.NEWEST, b.TIE_BREAK)
    lines = newest.select(
        F.col("l_orderkey").alias("ticket"), "l_linenumber", F.col("l_quantity").cast("int").alias("qty"),
        worth.alias("worth"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    names = b.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_name")
    heads = (coded_headers(spark, sf_dir) if heads is None else heads).select("ticket", "day", "location_code")
    ext = (F.col("worth") * F.lit("0.1").cast("decimal(2,1)")).cast(b.MONEY)
    rows = lines.withColumn("ext", ext).join(names, "supplier").join(heads, "ticket")
    cost = F.round(F.col("ext") / F.col("qty"), 4)
    return rows.select(
        F.concat(F.lit("INV-"), F.col("ticket")).alias("invoice_number"),
        F.col("l_linenumber").cast("string").alias("line_number"), "location_code",
        F.col("s_name").alias("vendor_name"), F.col("day").cast("string").alias("invoice_date"),
        F.date_add("day", 14).cast("string").alias("posted_date"),
        F.concat(F.lit("Part "), F.col("part")).alias("item_desc"),
        _text(F.col("qty"), "decimal(9,3)").alias("qty"),
        _pick(UNITS_OF_MEASURE, F.col("part") % 8).alias("uom"),
        F.when(F.col("part") % 50 == 0, "").otherwise(_text(cost, "decimal(9,4)")).alias("unit_cost"),
        _text(F.col("ext"), "decimal(12,2)").alias("ext_cost"))


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = b.units(spark, sf_dir).select("unit_id", "unit")
    return b.table(spark, sf_dir, "supplier").join(home, F.col("s_nationkey") == F.col("unit_id")) \
        .select(F.col("s_suppkey").cast("string").alias("vendor_id"),
                F.col("s_name").alias("vendor_name"), F.col("unit").alias("vendor_category"))


def labor(spark: SparkSession, sf_dir: str, heads: DataFrame | None = None) -> DataFrame:
    """One payroll row per order, roles in drifting spellings."""
    role = _pick(ROLES, F.substring("priority", 1, 1).cast("int") - 1)
    wages = F.col("order_value") * F.lit("0.01").cast("decimal(3,2)")
    return (coded_headers(spark, sf_dir) if heads is None else heads).select(
        F.col("day").cast("string").alias("business_date"), "location_code",
        label_text(role, F.col("ticket")).alias("role"),
        _text((F.col("ticket") % 80).cast("decimal(6,2)") / 10, "decimal(6,1)").alias("hours"),
        _text(wages, "decimal(9,2)").alias("wages"))


def _scaled(value: Column, factor: str) -> Column:
    return _text(value * F.lit(factor).cast("decimal(6,5)"), "decimal(12,2)")


def gl_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_headers(spark, sf_dir).groupBy("day", "location_code") \
        .agg(F.sum("order_value").alias("value")).select(
        F.col("day").cast("string").alias("business_date"), "location_code",
        _scaled(F.col("value"), "0.001").alias("gl_net_sales"))


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = coded_headers(spark, sf_dir).filter("day >= date'1996-01-01'") \
        .groupBy(F.trunc("day", "month").alias("m"), "location_code") \
        .agg(F.sum("order_value").alias("value"))
    return monthly.select(
        F.col("m").cast("string").alias("month_start"), "location_code",
        _scaled(F.col("value"), "0.0001").alias("net_sales_budget"),
        _scaled(F.col("value"), "0.00003").alias("cogs_budget"),
        _scaled(F.col("value"), "0.00002").alias("labor_budget"))


def dayparts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(DAYPARTS, "daypart string, start_time string, end_time string")


def item_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.aliases(spark, sf_dir).select(
        "alias", F.col("item_id").cast("string").alias("menu_item_id"))


def location_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.bridge(spark, sf_dir).select(
        "location_code", F.col("location_id").cast("string").alias("location_id"))


FEEDS = {
    "pos_ticket_lines": ticket_lines, "pos_locations": locations, "pos_menu_items": menu_items,
    "ap_invoice_lines": invoice_lines, "ap_vendors": vendors, "labor_daily": labor,
    "gl_daily_sales": gl_days, "plan_budget": budgets, "ref_calendar": calendar_text,
    "ref_dayparts": dayparts, "ref_item_aliases": item_aliases,
    "ref_location_bridge": location_bridge,
}


# Feeds that can be rendered for some tickets only.
BY_TICKET = ("pos_ticket_lines", "ap_invoice_lines", "labor_daily")


class RenderedFeeds(Mapping):
    """The feeds by name, each frame made when it is asked for; those of ``BY_TICKET`` for the tickets of ``heads`` only if given."""

    def __init__(self, spark: SparkSession, sf_dir: str, heads: DataFrame | None = None):
        self._spark, self._sf_dir, self._heads = spark, sf_dir, heads

    def __getitem__(self, name: str) -> DataFrame:
        heads = [self._heads] if name in BY_TICKET else []
        return FEEDS[name](self._spark, self._sf_dir, *heads).select(*RAW_FEEDS[name])

    def __iter__(self):
        return iter(FEEDS)

    def __len__(self) -> int:
        return len(FEEDS)
