"""Cleaning and conforming operators, each run over a whole source table.

Typed source columns are first rendered as the messy text an export would hold
and then cleaned back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import (backfill_ratio, band, blank_to_null, map_codes, parse_dates,
                         title_label, weekday_window_flag)
from ..operators import calendar, cleaning, conform
from . import bindings as b
from .analyses import plain

# Service bands by hour, last hour included; the rest is late night.
SERVICE_BANDS = [("breakfast", 7, 10), ("lunch", 11, 14), ("afternoon", 15, 16),
                 ("dinner", 17, 21)]
PRIORITY_CODES = {"1-urgent": "UR", "2-high": "HI", "3-medium": "ME"}


def date_text(day: Column, key: Column) -> Column:
    """A date in one of the three export formats."""
    return F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd")) \
        .when(key % 3 == 1, F.date_format(day, "MM/dd/yyyy")) \
        .otherwise(F.date_format(day, "yyyy/MM/dd"))


def label_text(label: Column, key: Column) -> Column:
    """A label as keyed in: lower case, padded upper case or as it should be."""
    return F.when(key % 3 == 0, F.lower(label)) \
        .when(key % 3 == 1, F.concat(F.lit(" "), F.upper(label), F.lit(" "))).otherwise(label)


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an all-text export."""
    key = F.col("o_orderkey")
    return b.table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_key"),
        date_text(F.col("o_orderdate").cast("date"), key).alias("order_date"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("order_value"),
        label_text(F.col("o_orderpriority"), key).alias("priority"))


def c01_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_text(spark, sf_dir).select(
        F.col("order_key").cast("bigint"), parse_dates("order_date").alias("order_date"))


def c01_parse_dates_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th date is impossible and every 51st has an unknown format."""
    key = F.col("order_key").cast("bigint")
    text = F.when(key % 50 == 0, "13/45/2024").when(key % 51 == 0, "05.03.2024") \
        .otherwise(F.col("order_date"))
    return order_text(spark, sf_dir).select(
        key.alias("order_key"), parse_dates(text, strict=False).alias("order_date"))


def c02_local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.event_rows(spark, sf_dir).select(
        "event_id", F.date_format("local_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("local_time"))


ORDER_TYPES = {"order_key": "bigint", "order_value": "decimal(14,2)"}


def c03_cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_text(spark, sf_dir).select("order_key", "order_value")
    return plain(cleaning.cast_columns(rows, ORDER_TYPES))


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 40th value is no number."""
    value = F.when(F.col("order_key").cast("bigint") % 40 == 0, "n/a") \
        .otherwise(F.col("order_value"))
    return order_text(spark, sf_dir).select("order_key", value.alias("order_value"))


def c03_cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cleaning.cast_lenient(_spoiled(spark, sf_dir), ORDER_TYPES)
    return plain(typed.withColumn("bad_columns", F.array_join("bad_columns", ",")))


def c03_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = cleaning.reject_rows(_spoiled(spark, sf_dir), ORDER_TYPES)
    return rejected.withColumn("bad_columns", F.array_join("bad_columns", ","))


def c04_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("unit_cost").cast("string"), F.lit(""))
    return plain(b.parts(spark, sf_dir).select(
        "part", blank_to_null(text).cast("decimal(12,4)").alias("unit_cost")))


def c05_map_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_text(spark, sf_dir).select(
        F.col("order_key").cast("bigint"), map_codes("priority", PRIORITY_CODES).alias("code"))


def c06_title_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.raw_names(spark, sf_dir).select(
        "part", title_label("keyed_name", {"old ring": "OLD Ring"}).alias("label"))


def c07_backfill_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh part's lines have no unit cost on the invoice."""
    known = F.when(F.col("part") % 7 != 0, (F.abs("qty") * F.lit("10.5").cast("decimal(3,1)"))
                   .cast("decimal(18,4)"))
    lines = b.line_items(spark, sf_dir).withColumn("unit_cost", known)
    filled = backfill_ratio("unit_cost", "list_value", F.abs("qty"), 4)
    return plain(lines.select("ticket", "line", "unit_cost",
                              filled.cast("decimal(18,4)").alias("unit_cost_filled")))


def c08_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "lineitem").select(*b.LINE_KEY, *b.NEWEST, *b.TIE_BREAK)
    return cleaning.keep_latest(raw, b.LINE_KEY, b.NEWEST).select(
        *b.LINE_KEY, F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey",
        "l_suppkey", F.col("l_extendedprice").cast(b.MONEY).cast("double").alias("price"))


def c08_rank_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "lineitem").select(*b.LINE_KEY, *b.NEWEST, *b.TIE_BREAK)
    return cleaning.rank_exports(raw, b.LINE_KEY, b.NEWEST).select(
        *b.LINE_KEY, "l_partkey", "l_suppkey", "export_seq")


def c09_resolve_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.resolve_alias(b.raw_names(spark, sf_dir), "keyed_name",
                                 b.aliases(spark, sf_dir)).select("part", "keyed_name", "item_id")


def coded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the location code that was valid on their day."""
    eras = b.unit_eras(spark, sf_dir)
    return conform.in_era(b.headers(spark, sf_dir), eras, "unit", "day") \
        .select("ticket", "day", "location_code", "order_value", "priority")


def c10_conform_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_orders(spark, sf_dir)
    return conform.conform_code(coded, b.bridge(spark, sf_dir), "location_code", "location_id") \
        .select("ticket", "location_code", "location_id")


def c11_lookup_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts by supplier name, then the surrogate id of the name."""
    supplier = b.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    counted = b.line_items(spark, sf_dir).groupBy("supplier") \
        .agg(F.count(F.lit(1)).alias("n_lines"))
    named = counted.join(supplier, F.col("supplier") == F.col("s_suppkey")) \
        .select("s_name", "n_lines")
    return conform.lookup_id(named, supplier, "s_name", "s_suppkey")


def c12_era_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.era_history(b.places(spark, sf_dir), b.bridge(spark, sf_dir),
                               attributes=["service_format"])


def c12_overlapping_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the first code of every fifth unit left open a year too long."""
    late = F.when(F.col("unit_id") % 10 == 0, F.add_months("closed_date", 12)) \
        .otherwise(F.col("closed_date"))
    history = conform.era_history(b.places(spark, sf_dir).withColumn("closed_date", late),
                                  b.bridge(spark, sf_dir))
    return conform.overlapping_eras(history).select("location_id", "location_code",
                                                    "latest_end_before")


def c13_current_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.current_dimension(b.places(spark, sf_dir), b.bridge(spark, sf_dir)) \
        .select("location_id", "location_code", "unit", "service_format", "open_date")


def c14_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.event_rows(spark, sf_dir).select(
        "event_id", band("local_ts", SERVICE_BANDS, "late_night").alias("daypart"))


def c15_weekday_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.event_rows(spark, sf_dir).select("event_id", weekday_window_flag(
        F.col("local_ts").cast("date"), "local_ts", (6, 7), 10, 14).alias("is_brunch"))


def c16_signed_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(b.line_items(spark, sf_dir).select("ticket", "line", "state", "net"))


def c17_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.headers(spark, sf_dir)
    keyed = rows.withColumn("priority", title_label(label_text(F.col("priority"), F.col("ticket"))))
    return plain(cleaning.collapse(keyed, ["unit", "priority"], ["order_value"]))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first order to the last."""
    day = F.col("o_orderdate").cast("date")
    span = b.table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("day"))


def c19_build_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(calendar.describe_days(order_days(spark, sf_dir), "day"))


def calendar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar as an all-text feed with blanks for missing labels."""
    built = calendar.describe_days(order_days(spark, sf_dir), "day")
    return built.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(
        "date_day" if c == "date_key" else c) for c in built.columns])


def c18_typed_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(calendar.typed_calendar(calendar_text(spark, sf_dir)))


CONFORMING = {f.__name__: f for f in (
    c01_parse_dates, c01_parse_dates_lenient, c02_local_time, c03_cast_strict, c03_cast_lenient,
    c03_reject_rows, c04_blank_to_null, c05_map_codes, c06_title_label, c07_backfill_ratio,
    c08_keep_latest, c08_rank_exports, c09_resolve_alias, c10_conform_code, c11_lookup_id,
    c12_era_history, c12_overlapping_eras, c13_current_dimension, c14_band, c15_weekday_window,
    c16_signed_net, c17_collapse, c18_typed_calendar, c19_build_calendar)}
