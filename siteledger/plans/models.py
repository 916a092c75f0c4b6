"""Eight staging views and ten marts over the raw text feeds.

Keys that grow with the data (ticket, item and vendor numbers) are bigint; all
other types are as declared for the feeds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (backfill_ratio, band, blank_to_null, map_codes, parse_dates, signed_net,
                         title_label, to_local_ntz, weekday_window_flag)
from ..operators import calendar, cleaning, conform, quality
from ..operators.costs import with_costs
from ..operators.declared import Declared, check_all, counted
from ..operators.drill import Fact, drill_across
from ..operators.reconcile import two_books
from .conforming import SERVICE_BANDS

Frames = Mapping[str, DataFrame]

LOCAL_TZ = "America/New_York"
# Spelling variants of the unit-of-measure codes.
UOM_CODES = {"case": "CS", "lb": "LB", "ea": "EA", "bag": "BG"}
# Category labels that title-casing would get wrong.
CATEGORY_LABELS = {"na beverages": "NA Beverages"}
TICKET_KEY = ["location_code", "business_date", "ticket_number", "line_number"]


def typed_ticket_lines(raw: Frames) -> DataFrame:
    rows = raw["pos_ticket_lines"]
    return rows.select(
        "location_code", parse_dates("business_date").alias("business_date"),
        F.col("ticket_number").cast("bigint").alias("ticket_number"),
        F.col("line_number").cast("smallint").alias("line_number"),
        to_local_ntz("closed_at", LOCAL_TZ).alias("closed_at"), "item_name",
        F.col("qty").cast("int").alias("qty"),
        F.col("unit_price").cast("decimal(9,2)").alias("unit_price"),
        F.col("discount_amount").cast("decimal(9,2)").alias("discount_amount"),
        "line_state", "order_mode")


def stg_pos__ticket_lines(raw: Frames) -> DataFrame:
    return cleaning.rank_exports(typed_ticket_lines(raw), TICKET_KEY, ["closed_at"])


def stg_pos__locations(raw: Frames) -> DataFrame:
    rows = raw["pos_locations"].withColumn("closed_date", blank_to_null("closed_date"))
    return cleaning.cast_columns(rows, {"seats": "smallint", "open_date": "date",
                                        "closed_date": "date"})


def stg_pos__menu_items(raw: Frames) -> DataFrame:
    rows = raw["pos_menu_items"].withColumns({
        "category": title_label("category", CATEGORY_LABELS),
        "theoretical_unit_cost": blank_to_null("theoretical_unit_cost")})
    return cleaning.cast_columns(rows, {
        "menu_item_id": "bigint", "standard_price": "decimal(7,2)",
        "theoretical_unit_cost": "decimal(7,4)"})


def stg_ap__invoice_lines(raw: Frames) -> DataFrame:
    rows = raw["ap_invoice_lines"].withColumns({
        "uom": map_codes("uom", UOM_CODES), "unit_cost": blank_to_null("unit_cost")})
    typed = cleaning.cast_columns(rows, {
        "line_number": "smallint", "invoice_date": "date", "posted_date": "date",
        "qty": "decimal(9,3)", "unit_cost": "decimal(9,4)", "ext_cost": "decimal(12,2)"})
    return typed.withColumn("unit_cost_filled", backfill_ratio(
        "unit_cost", "ext_cost", "qty", 4).cast("decimal(9,4)"))


def stg_ap__vendors(raw: Frames) -> DataFrame:
    return cleaning.cast_columns(raw["ap_vendors"], {"vendor_id": "bigint"})


def stg_labor__daily(raw: Frames) -> DataFrame:
    rows = raw["labor_daily"].withColumn("role", title_label("role"))
    return cleaning.cast_columns(rows, {"business_date": "date", "hours": "decimal(6,2)",
                                        "wages": "decimal(9,2)"})


def stg_gl__daily_sales(raw: Frames) -> DataFrame:
    return cleaning.cast_columns(raw["gl_daily_sales"], {
        "business_date": "date", "gl_net_sales": "decimal(12,2)"})


def stg_plan__budget(raw: Frames) -> DataFrame:
    return cleaning.cast_columns(raw["plan_budget"], {
        "month_start": "date", "net_sales_budget": "decimal(12,2)",
        "cogs_budget": "decimal(12,2)", "labor_budget": "decimal(12,2)"})


def _bridge(raw: Frames) -> DataFrame:
    return cleaning.cast_columns(raw["ref_location_bridge"], {"location_id": "smallint"})


def _conformed(raw: Frames, rows: DataFrame) -> DataFrame:
    return conform.conform_code(rows, _bridge(raw), "location_code", "location_id")


def dim_location(raw: Frames) -> DataFrame:
    return conform.current_dimension(stg_pos__locations(raw), _bridge(raw)).select(
        "location_id", "location_code", "location_name", "neighborhood", "borough",
        "service_format", "volume_tier", "seats", "open_date")


def dim_location_history(raw: Frames) -> DataFrame:
    return conform.era_history(stg_pos__locations(raw), _bridge(raw),
                               attributes=["service_format", "volume_tier", "seats"])


def dim_date(raw: Frames) -> DataFrame:
    return calendar.typed_calendar(raw["ref_calendar"])


def dim_menu_item(raw: Frames) -> DataFrame:
    return stg_pos__menu_items(raw)


def dim_vendor(raw: Frames) -> DataFrame:
    return stg_ap__vendors(raw)


def fact_ticket_line(raw: Frames) -> DataFrame:
    """One deduplicated, conformed line; the net rule is applied here and nowhere else."""
    latest = cleaning.keep_latest(typed_ticket_lines(raw), TICKET_KEY, ["closed_at"])
    aliases = cleaning.cast_columns(raw["ref_item_aliases"], {"menu_item_id": "bigint"})
    lines = conform.resolve_alias(_conformed(raw, latest), "item_name", aliases,
                                  item_id="menu_item_id")
    return lines.select(
        "location_id", "business_date", "ticket_number", "line_number", "closed_at",
        band("closed_at", SERVICE_BANDS, "late_night").alias("daypart"),
        weekday_window_flag("business_date", "closed_at", (6, 7), 10, 14).alias("is_brunch"),
        "menu_item_id", "qty", "unit_price", "discount_amount", "line_state", "order_mode",
        (F.col("qty") * F.col("unit_price")).cast("decimal(11,2)").alias("gross_amount"),
        signed_net("line_state", "qty", "unit_price", "discount_amount").alias("net_amount"))


def fact_invoice_line(raw: Frames) -> DataFrame:
    rows = conform.lookup_id(_conformed(raw, stg_ap__invoice_lines(raw)), stg_ap__vendors(raw),
                             "vendor_name", "vendor_id")
    return rows.select("invoice_number", "line_number", "location_id", "vendor_id",
                       "invoice_date", "posted_date", "item_desc", "qty", "uom", "unit_cost",
                       "unit_cost_filled", "ext_cost")


def fact_labor_day(raw: Frames) -> DataFrame:
    return cleaning.collapse(_conformed(raw, stg_labor__daily(raw)),
                             ["location_id", "business_date", "role"], ["hours", "wages"])


def fact_gl_day(raw: Frames) -> DataFrame:
    return _conformed(raw, stg_gl__daily_sales(raw)).select(
        "location_id", "business_date", "gl_net_sales")


def fact_budget_month(raw: Frames) -> DataFrame:
    return _conformed(raw, stg_plan__budget(raw)).select(
        "location_id", "month_start", "net_sales_budget", "cogs_budget", "labor_budget")


STAGING = {f.__name__: f for f in (
    stg_pos__ticket_lines, stg_pos__locations, stg_pos__menu_items, stg_ap__invoice_lines,
    stg_ap__vendors, stg_labor__daily, stg_gl__daily_sales, stg_plan__budget)}
MARTS = {f.__name__: f for f in (
    dim_location, dim_location_history, dim_date, dim_menu_item, dim_vendor, fact_ticket_line,
    fact_invoice_line, fact_labor_day, fact_gl_day, fact_budget_month)}

# The key of each mart.
MART_KEYS = {
    "dim_location": ["location_id"],
    "dim_location_history": ["location_id", "valid_from"],
    "dim_date": ["date_key"],
    "dim_menu_item": ["menu_item_id"],
    "dim_vendor": ["vendor_id"],
    "fact_ticket_line": ["location_id", "business_date", "ticket_number", "line_number"],
    "fact_invoice_line": ["invoice_number", "line_number"],
    "fact_labor_day": ["location_id", "business_date", "role"],
    "fact_gl_day": ["location_id", "business_date"],
    "fact_budget_month": ["location_id", "month_start"],
}

# Accepted labels.
ACCEPTED = {
    ("dim_location", "service_format"): ["full_service", "counter_service"],
    ("dim_location", "volume_tier"): ["T1", "T2", "T3", "T4"],
    ("dim_date", "holiday_type"): ["federal", "observance", "city_event"],
    ("fact_ticket_line", "line_state"): ["sale", "void", "comp", "refund"],
    ("fact_ticket_line", "order_mode"): ["DI", "TO", "DL"],
    ("fact_ticket_line", "daypart"): ["breakfast", "lunch", "afternoon", "dinner", "late_night"],
    ("fact_labor_day", "role"): ["Manager", "Line Cook", "Prep Cook", "Server", "Busser",
                                 "Bartender", "Counter", "Dishwasher"],
}
# Columns that must be filled, unique ones, and references (mart, column, parent, its key).
REQUIRED = [("dim_location", "location_id"), ("dim_location_history", "location_id"),
            ("dim_date", "date_key"), ("dim_menu_item", "menu_item_id"),
            ("dim_menu_item", "item_name"), ("dim_vendor", "vendor_id"),
            ("fact_ticket_line", "location_id"), ("fact_ticket_line", "business_date"),
            ("fact_invoice_line", "ext_cost")]
UNIQUE = [("dim_location", "location_id"), ("dim_date", "date_key"),
          ("dim_menu_item", "menu_item_id"), ("dim_menu_item", "item_name"),
          ("dim_vendor", "vendor_id")]
REFERENCES = [("dim_location_history", "location_id", "dim_location", "location_id"),
              ("fact_ticket_line", "location_id", "dim_location", "location_id"),
              ("fact_ticket_line", "business_date", "dim_date", "date_key"),
              ("fact_ticket_line", "menu_item_id", "dim_menu_item", "menu_item_id"),
              ("fact_invoice_line", "location_id", "dim_location", "location_id"),
              ("fact_invoice_line", "vendor_id", "dim_vendor", "vendor_id"),
              ("fact_labor_day", "location_id", "dim_location", "location_id"),
              ("fact_gl_day", "location_id", "dim_location", "location_id"),
              ("fact_budget_month", "location_id", "dim_location", "location_id")]


def build_marts(raw: Frames) -> dict[str, DataFrame]:
    return {name: build(raw) for name, build in MARTS.items()}


def mart_checks(raw: Frames, marts: Frames, boroughs: list[str] | None = None,
                categories: list[str] | None = None, max_variance_days: int = 45
                ) -> dict[str, DataFrame]:
    """Every declared check of the marts as a frame of violations.

    ``marts`` should be written tables: each check reads them again.
    """
    sold = marts["fact_ticket_line"]
    accepted = dict(ACCEPTED)
    if boroughs:
        accepted["dim_location", "borough"] = boroughs
    if categories:
        accepted["dim_menu_item", "category"] = categories
    checks = {f"grain {m}": quality.grain(marts[m], keys) for m, keys in MART_KEYS.items()}
    checks |= {f"not_null {m}.{c}": quality.not_null(marts[m], c) for m, c in REQUIRED}
    checks |= {f"unique {m}.{c}": quality.unique(marts[m], c) for m, c in UNIQUE}
    checks |= {f"accepted {m}.{c}": quality.accepted_values(marts[m], c, values)
               for (m, c), values in accepted.items()}
    checks |= {f"reference {m}.{c}": quality.relationships(marts[m], c, marts[parent], key)
               for m, c, parent, key in REFERENCES}
    checks["not_null staged business_date"] = quality.not_null(typed_ticket_lines(raw), "business_date")
    due = F.when(F.col("line_state") == "refund", F.col("gross_amount")) \
        .when(F.col("line_state") == "sale", F.col("gross_amount") - F.col("discount_amount")).otherwise(F.lit(0))
    off = sold.withColumn("_off", F.abs(F.col("net_amount") - due))
    for states in (("sale", "refund"), ("void", "comp")):
        checks["net rule " + " ".join(states)] = quality.expression_is_true(
            off.filter(F.col("line_state").isin(*states)), "_off = 0")
    checks["alias map total"] = quality.map_total(
        raw["pos_ticket_lines"], "item_name", raw["ref_item_aliases"])
    day = ["location_id", "business_date"]
    net = sold.groupBy(*day).agg(F.sum("net_amount").alias("net"))
    checks["books tie"] = quality.bounded_variance(
        two_books(net, marts["fact_gl_day"], day, "net", "gl_net_sales"), max_variance_days)
    checks["cost ratio plausible"] = quality.ratio_in_band(
        monthly_costs(marts), ["location_id", "month_start"], "net", ["purchases", "labor"], 35, 90)
    checks["codes conserved"] = quality.conservation(
        raw["pos_ticket_lines"], _conformed(raw, raw["pos_ticket_lines"]))
    checks["eras apart"] = conform.overlapping_eras(marts["dim_location_history"])
    return checks


def net_rule(states: tuple[str, ...]) -> Column:
    """The net amount of a line in one of these states is what its gross and discount say."""
    due = F.when(F.col("line_state") == "refund", F.col("gross_amount")) \
        .when(F.col("line_state") == "sale", F.col("gross_amount") - F.col("discount_amount")).otherwise(F.lit(0))
    return ~F.col("line_state").isin(*states) | (F.col("net_amount") == due)


def declared_marts() -> dict[str, Declared]:
    """The declared checks of each mart."""
    rules = {f"net rule {' '.join(states)}": net_rule(states) for states in (("sale", "refund"), ("void", "comp"))}
    return {mart: Declared(
        keys=[keys],
        not_null=[c for m, c in REQUIRED if m == mart], unique=[c for m, c in UNIQUE if m == mart],
        accepted={c: values for (m, c), values in ACCEPTED.items() if m == mart},
        references={c: (parent, key) for m, c, parent, key in REFERENCES if m == mart},
        true=rules if mart == "fact_ticket_line" else {}) for mart, keys in MART_KEYS.items()}


def mart_check_counts(raw: Frames, marts: Frames, max_variance_days: int = 45) -> DataFrame:
    """(check, violations) for every declared check: one scan of each mart for all that one table can tell.

    The checks that compare several marts, or a mart with the feeds, follow, each as one count.  ``marts`` should be
    written tables.
    """
    sold, day = marts["fact_ticket_line"], ["location_id", "business_date"]
    net = sold.groupBy(*day).agg(F.sum("net_amount").alias("net"))
    totals = drill_across([
        Fact(sold, "business_date", {"net": "net_amount"}), Fact(marts["fact_invoice_line"], "invoice_date", {"purchases": "ext_cost"}),
        Fact(marts["fact_labor_day"], "business_date", {"labor": "wages"})], ["location_id"])
    across = {
        "not_null staged business_date": quality.not_null(typed_ticket_lines(raw), "business_date"),
        "alias map total": quality.map_total(raw["pos_ticket_lines"], "item_name", raw["ref_item_aliases"]),
        "books tie": quality.bounded_variance(
            two_books(net, marts["fact_gl_day"], day, "net", "gl_net_sales"), max_variance_days),
        "cost ratio plausible": quality.ratio_in_band(
            totals, ["location_id", "month_start"], "net", ["purchases", "labor"], 35, 90),
        "codes conserved": quality.conservation(
            raw["pos_ticket_lines"], _conformed(raw, raw["pos_ticket_lines"])),
        "eras apart": conform.overlapping_eras(marts["dim_location_history"])}
    return check_all(marts, declared_marts()).unionByName(counted(across))


def _by_month(rows: DataFrame, day: str, value: str, out: str) -> DataFrame:
    return rows.groupBy("location_id", F.trunc(day, "month").alias("month_start")) \
        .agg(F.sum(value).alias(out))


def monthly_costs(marts: Frames) -> DataFrame:
    """Net, purchases and labor by location and month, each fact summed before the joins."""
    net = _by_month(marts["fact_ticket_line"], "business_date", "net_amount", "net")
    bought = _by_month(marts["fact_invoice_line"], "invoice_date", "ext_cost", "purchases")
    worked = _by_month(marts["fact_labor_day"], "business_date", "wages", "labor")
    return with_costs(net, [bought, worked], ["location_id", "month_start"])
