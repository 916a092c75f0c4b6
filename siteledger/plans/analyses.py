"""The business questions on the bound tables, one function per statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import band
from ..operators import costs, growth, hierarchy, metrics, mix, reconcile, streaks
from ..operators.conform import ambiguous_aliases, resolve_alias, unmapped_names
from ..sources.landing import pin
from . import bindings as b

COMP_RATE = 0.05
ERA_DAY = "1998-06-01"
FOLDS = {"PROMO": "ECONOMY"}
WINDOWS = {"pre": ("1996-12-01", "1997-02-28"), "post": ("1999-09-01", "1999-11-30")}
BRIDGE_WINDOWS = {"baseline": ("1996-01-01", "1996-12-31"),
                  "trailing": ("2000-07-01", "2001-06-30")}
GROWTH_SPANS = ("1998-01-01", "1998-06-30"), ("1997-01-01", "1997-06-30")
NOW, BASE = ("2001-01-01", "2001-06-30"), ("2000-01-01", "2000-06-30")
BRIDGE_UNIT = "NATION_7"
STREAK_THRESHOLD = 38.0
DEFAULT_TARGET = 34.0
PEER_FACTOR = 0.95
PRICE_MOVE = 1.0
HOUR_BANDS = [("night", 0, 5), ("morning", 6, 11), ("midday", 12, 17)]
BAND_ORDER = ["night", "morning", "midday", "evening"]


def hull(spans: dict[str, tuple[str, str]]) -> tuple[str, str]:
    """The date range from the first start to the last end of named windows."""
    return min(s[0] for s in spans.values()), max(s[1] for s in spans.values())


def plain(df: DataFrame) -> DataFrame:
    """Output types for reports: exact decimals leave as double, small ints as int."""
    def column(name: str, kind: str) -> Column:
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind in ("smallint", "tinyint"):
            return F.col(name).cast("int").alias(name)
        return F.col(name)
    return df.select(*[column(n, k) for n, k in df.dtypes])


def a01a_monthly_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics.monthly_net(b.ticket_sales(spark, sf_dir), "unit", "day", "net",
                                     F.col("comp_gross"), F.count(F.lit(1))))


def a01b_comp_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics.rate_exceptions(b.ticket_sales(spark, sf_dir), "unit", "day",
                                         F.col("comp_gross"), F.col("sale_gross"), COMP_RATE))


def a02_duplicate_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = b.copies(spark, sf_dir).withColumn("month", F.date_format("day", "yyyy-MM"))
    return plain(reconcile.duplicate_impact(keyed, "unit", "month"))


def keyed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units by name as keyed in: summed per part first, so names join few rows."""
    counted = b.lines_only(spark, sf_dir).filter(F.col("state").isin("sale", "comp")) \
        .groupBy("part").agg(F.sum("qty").alias("units"))
    named = b.raw_names(spark, sf_dir).join(counted, "part")
    return named.groupBy("keyed_name").agg(F.sum("units").alias("units"))


def a03a_canonical_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = b.aliases(spark, sf_dir)
    names = aliases.select("item_id", "item_name").distinct()
    resolved = resolve_alias(keyed_units(spark, sf_dir), "keyed_name", aliases)
    drifted = F.when(F.col("keyed_name") != F.col("item_name"), F.col("units"))
    return resolved.join(names, "item_id").groupBy("item_name").agg(
        F.count(F.lit(1)).alias("spellings"), F.sum("units").alias("total_units"),
        F.sum(drifted).alias("drifted_units")).filter("spellings > 1") \
        .orderBy(F.col("drifted_units").desc_nulls_last(), "item_name")


def a03b_unmapped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmapped_names(b.raw_names(spark, sf_dir), "keyed_name", b.aliases(spark, sf_dir))


def a03c_ambiguous_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part name itself as alias of the part number: most names claim several."""
    return ambiguous_aliases(b.raw_names(spark, sf_dir), "keyed_name", "part")


def openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.headers(spark, sf_dir).groupBy("unit") \
        .agg(F.trunc(F.min("day"), "month").alias("open_date"))


def a04a_comparable_growth(spark: SparkSession, sf_dir: str, both_ends: bool = True) -> DataFrame:
    # Unit-months are few, and every step reads them: written once.
    monthly = pin(b.monthly_orders(spark, sf_dir), "unit-months")[0]
    opened = monthly.groupBy("unit").agg(F.min("month_start").alias("open_date"))
    return growth.comparable_growth(monthly, opened, b.unit_eras(spark, sf_dir), "unit", "value",
                                    both_ends=both_ends)


def a04a_current_end_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a04a_comparable_growth(spark, sf_dir, both_ends=False)


def a04b_two_period_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans around the re-coding, so that the converted units are left out."""
    return growth.two_period_growth(
        b.headers(spark, sf_dir), openings(spark, sf_dir), b.unit_eras(spark, sf_dir), "unit",
        "day", "order_value", *GROWTH_SPANS)


def a05_ratio_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = costs.period_totals(b.ticket_costs(spark, sf_dir), "unit", "day",
                                 {"net": "net", "labor": "labor", "purchases": "purchases"})
    return plain(costs.ratio_vs_target(
        totals, b.plan_rows(spark, sf_dir), "unit", "net", ["purchases", "labor"], "plan_net",
        ["plan_purchases", "plan_labor"], DEFAULT_TARGET, 2.0)
        .orderBy(F.col("miss_pts").desc_nulls_first(), "unit", "month"))


def a06a_quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    era = F.when(F.col("day") >= F.lit(ERA_DAY).cast("date"), "post").otherwise("pre")
    sold = b.sales(spark, sf_dir).filter("state = 'sale'") \
        .groupBy("part", era.alias("era")).agg(F.sum("qty").alias("units"))
    items = sold.join(b.parts(spark, sf_dir), "part") \
        .select(mix.fold_labels("category", FOLDS).alias("category"), "era", "part", "units", "price", "unit_cost")
    # Few rows beside the lines, and every median reads them: written once.
    return plain(mix.quadrants(pin(items, "sold-items")[0], ["category", "era"], "part", "units", "price", "unit_cost"))


def a06b_top_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.sales(spark, sf_dir).filter("state = 'sale'") \
        .withColumn("year", F.year("day")).withColumn("quarter", F.quarter("day"))
    return mix.top_per_group(rows, ["unit", "year", "quarter"], "part", "qty", 3)


def _event_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.event_rows(spark, sf_dir).withColumn("band", band("ts", HOUR_BANDS, "evening"))
    return mix.band_grid(rows.withColumn("peer_group", F.lit("all")),
                         ["unit", "peer_group"], "band", "value")


def a07a_band_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.band_shares(_event_grid(spark, sf_dir), "unit", "band", BAND_ORDER)


def a07b_below_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.below_peers(_event_grid(spark, sf_dir), "unit", "peer_group", "band", PEER_FACTOR)


def _recoded_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eras of the units that have more than one."""
    eras = b.unit_eras(spark, sf_dir)
    several = eras.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("unit")
    return eras.join(several, "unit", "left_semi")


def a07c_era_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.era_band(b.headers(spark, sf_dir), _recoded_eras(spark, sf_dir), "unit", "day",
                        "order_value", F.col("priority") == "1-URGENT", "location_code")


def attach_tickets(spark: SparkSession, sf_dir: str, category: str = "PROMO",
                   span: tuple[str, str] | None = None) -> DataFrame:
    """Tickets with any-line flags: has a sale, has a sale of one category."""
    kinds = b.parts(spark, sf_dir).select("part", (F.col("category") == category).alias("hit"))
    sale = F.col("state") == "sale"
    return flag_tickets(spark, sf_dir, {"attached": F.col("hit") & sale, "has_sale": sale},
                        kinds, span)


def flag_tickets(spark: SparkSession, sf_dir: str, flags: dict[str, Column],
                 items: DataFrame | None = None, span: tuple[str, str] | None = None) -> DataFrame:
    """Any-line flags per ticket, optionally with item attributes and in a date range."""
    fact = b.published(spark, sf_dir, "sales")
    if fact is not None:
        lines = metrics.within(fact, "day", span) if span else fact
    else:
        heads = b.headers(spark, sf_dir)
        heads = metrics.within(heads, "day", span) if span else heads
        lines = b.line_items(spark, sf_dir, heads if span else None)
    if items is not None:
        lines = lines.join(items, "part")
    if fact is not None:
        return metrics.ticket_rollup(lines, b.TICKET_LEVEL, flags=flags)
    return metrics.ticket_rollup(lines, ["ticket"], flags=flags).join(heads, "ticket")


def a07d_attach_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.share_of_tickets(attach_tickets(spark, sf_dir).filter("has_sale"),
                                    "unit", "attached", 1, "attach_pct")


def _weekly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = costs.period_totals(b.ticket_costs(spark, sf_dir), "area", "day",
                                 {"net": "net", "labor": "labor", "purchases": "purchases"},
                                 grain="week")
    return streaks.rolling_flags(weekly, "area", "net", ["purchases", "labor"], STREAK_THRESHOLD)


def a08_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaks.streaks(_weekly_flags(spark, sf_dir), "area")


def a08_streaks_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaks.streaks(_weekly_flags(spark, sf_dir), "area", consecutive="observed")


def both_books(spark: SparkSession, sf_dir: str, how: str = "full_outer", span: tuple[str, str] | None = None
               ) -> DataFrame:
    left, right = b.books(spark, sf_dir, span)
    return reconcile.two_books(left, right, ["unit", "day"], "net", "booked", how)


def a09a_tie_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reconcile.tie_out_exceptions(both_books(spark, sf_dir), "unit", "day"))


def a09a_tie_out_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reconcile.tie_out_exceptions(both_books(spark, sf_dir), "unit", "day",
                                              detect_shift=True))


def a09b_tied_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.tied_days(both_books(spark, sf_dir, "inner"), "unit")


def unit_prices(spark: SparkSession, sf_dir: str, span: tuple[str, str] | None = None) -> DataFrame:
    """Price per piece of every line, with item attributes, in a date range if given."""
    price = F.round(F.col("list_value") / F.abs("qty"), 4).cast("decimal(18,4)")
    return b.sales(spark, sf_dir, span).withColumn("unit_price", price) \
        .join(b.parts(spark, sf_dir), "part")


def a10a_price_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return costs.price_steps(unit_prices(spark, sf_dir), ["brand"], "day", "unit_price", PRICE_MOVE)


def a10b_ratio_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = costs.window_sums(b.ticket_costs(spark, sf_dir, hull(WINDOWS)), ["unit"], "day",
                             ["purchases", "net"], WINDOWS)
    return costs.ratio_in_windows(sums, "unit", "purchases", "net", "pre", "post")


def a11a_vs_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.vs_group_mean(b.ticket_sales(spark, sf_dir, ("1997-06-01", "1999-06-30")), "unit", "day", "net",
                                 ["1997-06-01", "1998-06-01", "1999-06-01"])


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = b.units(spark, sf_dir)
    root = unit.agg(F.lit("group").alias("node"), F.lit(None).cast("string").alias("parent"))
    areas = unit.select(F.col("area").alias("node"), F.lit("group").alias("parent")).distinct()
    return unit.select(F.col("unit").alias("node"), F.col("area").alias("parent")) \
        .unionByName(areas).unionByName(root)


def a11b_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_sales(spark, sf_dir, ("2000-07-01", "2001-06-30"))
    total = hierarchy.rollup_levels(rows, ["unit", "area"], "net")
    return total.select("node", F.round(F.col("net_sales").cast("double"), 0).alias("net_sales"),
                        F.col("leaves").alias("units"))


def a11b_hierarchy_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One level deeper: suppliers under their nation."""
    supplier = b.table(spark, sf_dir, "supplier").join(
        b.units(spark, sf_dir), F.col("s_nationkey") == F.col("unit_id"))
    nodes = tree_nodes(spark, sf_dir).unionByName(
        supplier.select(F.col("s_name").alias("node"), F.col("unit").alias("parent")))
    lines = b.lines_only(spark, sf_dir).groupBy("supplier").agg(F.sum("net").alias("net"))
    leaves = lines.join(supplier, F.col("supplier") == F.col("s_suppkey"))
    total = hierarchy.rollup_tree(leaves, "s_name", "net", nodes)
    return total.select("node", F.round(F.col("net_sales").cast("double"), 0).alias("net_sales"),
                        F.col("leaves").alias("units"))


def a11c_era_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.era_totals(b.ticket_sales(spark, sf_dir), _recoded_eras(spark, sf_dir), "unit",
                          "day", "net", ["location_code", "service_format"])


def a12a_cost_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_costs(spark, sf_dir, hull(BRIDGE_WINDOWS), BRIDGE_UNIT)
    return costs.cost_bridge(rows, "day", "net", "labor", "purchases", BRIDGE_WINDOWS)


def a12b_target_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.ticket_costs(spark, sf_dir, BRIDGE_WINDOWS["trailing"], BRIDGE_UNIT)
    return costs.target_miss(rows, "day", "net", ["labor", "purchases"],
                             BRIDGE_WINDOWS["trailing"], 35.0)


def a13a_run_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics.run_rate(b.ticket_sales(spark, sf_dir), "unit", "day", "net"))


def a13b_group_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.ticket_costs(spark, sf_dir).agg(costs.pct(
        F.sum("labor") + F.sum("purchases"), F.sum("net")).alias("cost_pct"))


def a13c_highest_comp_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.highest_rates(b.ticket_sales(spark, sf_dir), "unit", "day",
                                 F.col("comp_gross"), F.col("net"))


ANALYSES = {f.__name__: f for f in (
    a01a_monthly_net, a01b_comp_exceptions, a02_duplicate_impact, a03a_canonical_rollup,
    a03b_unmapped_names, a03c_ambiguous_aliases, a04a_comparable_growth, a04a_current_end_only,
    a04b_two_period_growth, a05_ratio_vs_target, a06a_quadrants, a06b_top_three,
    a07a_band_shares, a07b_below_peers, a07c_era_band, a07d_attach_rate, a08_streaks,
    a08_streaks_observed, a09a_tie_out, a09a_tie_out_shifted, a09b_tied_days, a10a_price_steps,
    a10b_ratio_in_windows, a11a_vs_group, a11b_hierarchy, a11b_hierarchy_suppliers,
    a11c_era_verdict, a12a_cost_bridge, a12b_target_miss, a13a_run_rate, a13b_group_ratio,
    a13c_highest_comp_months)}
