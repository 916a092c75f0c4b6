"""All-text landing of delimited feeds under a fixed column contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

# The column order of each raw feed is its file contract.
RAW_FEEDS = {
    "pos_ticket_lines": ("location_code", "business_date", "ticket_number", "line_number",
                         "closed_at", "item_name", "qty", "unit_price", "discount_amount",
                         "line_state", "order_mode"),
    "pos_locations": ("location_code", "location_name", "neighborhood", "borough",
                      "service_format", "volume_tier", "seats", "open_date", "closed_date"),
    "pos_menu_items": ("menu_item_id", "item_name", "category", "standard_price",
                       "theoretical_unit_cost"),
    "ap_invoice_lines": ("invoice_number", "line_number", "location_code", "vendor_name",
                         "invoice_date", "posted_date", "item_desc", "qty", "uom", "unit_cost",
                         "ext_cost"),
    "ap_vendors": ("vendor_id", "vendor_name", "vendor_category"),
    "labor_daily": ("business_date", "location_code", "role", "hours", "wages"),
    "gl_daily_sales": ("business_date", "location_code", "gl_net_sales"),
    "plan_budget": ("month_start", "location_code", "net_sales_budget", "cogs_budget",
                    "labor_budget"),
    "ref_calendar": ("date_day", "year", "quarter", "month", "month_name", "day_of_week",
                     "day_name", "is_weekend", "is_holiday", "holiday_name", "holiday_type",
                     "is_school_break", "is_dining_week", "is_marathon_sunday"),
    "ref_dayparts": ("daypart", "start_time", "end_time"),
    "ref_item_aliases": ("alias", "menu_item_id"),
    "ref_location_bridge": ("location_code", "location_id"),
}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])



def read_raw(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read CSV as text only.

    Column order is checked against each file's header (``enforceSchema=false``), so a
    moved column fails the job instead of shifting values; short or long rows
    fail too.  A missing path fails when the frame is made.
    """
    return spark.read.schema(text_schema(columns)).option("header", True) \
        .option("enforceSchema", False).option("mode", "FAILFAST") \
        .option("escape", '"').csv(path)
