import datetime as dt
import random
import statistics
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger.functions import month_start
from siteledger.operators import costs, growth, hierarchy, metrics, mix, reconcile, streaks
from siteledger.operators.quantiles import group_percentile

DAY = dt.date


def months(first, n):
    return [DAY(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1)
            for i in range(n)]


# ---- sales metrics

LINES = [("U", DAY(2025, 1, 3), 1, "sale", D("10.00"), D("9.00")),
         ("U", DAY(2025, 1, 3), 1, "comp", D("4.00"), D("0.00")),
         ("U", DAY(2025, 1, 9), 2, "refund", D("-2.00"), D("-2.00")),
         ("U", DAY(2025, 2, 1), 3, "sale", D("100.00"), D("100.00")),
         ("U", DAY(2025, 2, 1), 3, "comp", D("3.00"), D("0.00"))]
LINE_SCHEMA = "unit string, day date, ticket int, state string, gross decimal(9,2), net decimal(9,2)"


def test_monthly_net_over_lines_and_over_tickets(rows):
    lines = rows(LINE_SCHEMA, *LINES)
    comp = F.when(F.col("state") == "comp", F.col("gross"))
    over_lines = metrics.monthly_net(lines, "unit", "day", "net", comp, F.count_distinct("ticket"))
    want = [("U", 2025, 1, D("7.00"), D("4.00"), 2), ("U", 2025, 2, D("100.00"), D("3.00"), 1)]
    assert values(over_lines) == want
    tickets = metrics.ticket_rollup(lines, ["unit", "day", "ticket"], {"net": F.col("net"), "comp": comp})
    over_tickets = metrics.monthly_net(tickets, "unit", "day", "net", F.col("comp"), F.count(F.lit(1)))
    assert values(over_tickets) == want


def test_rate_exceptions_are_strictly_above(rows):
    lines = rows(LINE_SCHEMA, *LINES)
    part, whole = (F.when(F.col("state") == s, F.col("gross")) for s in ("comp", "sale"))
    got = metrics.rate_exceptions(lines, "unit", "day", part, whole, 0.03)
    assert values(got, "month", "comp_rate_pct") == [(1, 40.0)]


def test_attach_counts_tickets_with_a_sale_only(rows):
    lines = rows("unit string, ticket int, state string, drink boolean",
                 ("U", 1, "void", True), ("U", 1, "sale", False), ("U", 2, "void", True),
                 ("U", 3, "sale", True), ("U", 3, "sale", False))
    sale = F.col("state") == "sale"
    tickets = metrics.ticket_rollup(lines, ["unit", "ticket"],
                                    flags={"attached": F.col("drink") & sale, "has_sale": sale})
    assert values(metrics.share_of_tickets(tickets.filter("has_sale"), "unit", "attached")) == [("U", 50.0)]


def test_shares_and_growth(rows):
    df = rows("k string, d date, v decimal(9,2)", ("a", DAY(2024, 1, 1), D("1.00")),
              ("a", DAY(2025, 1, 1), D("2.00")), ("b", DAY(2025, 1, 1), D("5.00")))
    assert values(metrics.share_of_total(df, "k", "v")) == [("a", 37.5), ("b", 62.5)]
    got = metrics.period_growth(df, "k", "d", "v", ("2025-01-01", "2025-12-31"), ("2024-01-01", "2024-12-31"))
    assert values(got) == [("a", 100.0), ("b", None)]


def test_group_mean_run_rate_and_rates(rows):
    df = rows("u string, d date, v decimal(9,2), c decimal(9,2)",
              ("a", DAY(2025, 6, 1), D("10.00"), D("1.00")), ("a", DAY(2025, 6, 30), D("20.00"), D("0.00")),
              ("b", DAY(2025, 6, 5), D("90.00"), D("45.00")), ("b", DAY(2025, 7, 1), D("-5.00"), D("5.00")))
    assert values(metrics.vs_group_mean(df, "u", "d", "v", ["2025-06-01"])) == \
        [("a", "2025-06", 30.0, 60.0, -50.0), ("b", "2025-06", 90.0, 60.0, 50.0)]
    assert values(metrics.run_rate(df, "u", "d", "v"), "u", "open_days", "annualized_net") == \
        [("a", 2, 5475.0), ("b", 2, 15512.5)]
    assert values(metrics.highest_rates(df, "u", "d", F.col("c"), F.col("v"), 4)) == \
        [("a", "2025-06", 3.3), ("b", "2025-06", 50.0)]


# ---- comparable growth

def growth_of(rows, data, opened, eras, **options):
    monthly = rows("unit string, month_start date, v decimal(9,2)", *data)
    openings = rows("unit string, open_date date", *opened)
    history = rows("unit string, valid_from date", *eras)
    result = growth.comparable_growth(monthly, openings, history, "unit", "v", **options)
    return {r.month: (r.naive_yoy_pct, r.comp_yoy_pct, r.comp_units) for r in result.collect()}


def test_missing_month_is_no_base_and_does_not_shift_others(rows):
    data = [("a", m, D(100 + i)) for i, m in enumerate(months(DAY(2024, 1, 1), 24)) if m != DAY(2024, 6, 1)]
    got = growth_of(rows, data, [("a", DAY(2010, 1, 1))], [("a", DAY(2010, 1, 1))])
    assert "2025-06" not in got and len(got) == 11
    assert got["2025-01"] == (12.0, 12.0, 1)
    assert got["2025-07"] == (round(100 * (118 / 106 - 1), 2),) * 2 + (1,)
    monthly = rows("unit string, month_start date, v decimal(9,2)", *data)
    shifted = monthly.selectExpr("month_start", "lag(v, 12) over (partition by unit order by month_start) as b")
    assert got["2025-02"][0] == round(100 * (113 / 101 - 1), 2)
    assert shifted.filter("month_start = date'2025-02-01'").first().b == D("100.00")  # January: lag counts rows


def test_opening_is_tested_at_both_ends(rows):
    data = [("a", DAY(2024, 1, 1), D(1)), ("a", DAY(2025, 1, 1), D(2)),
            ("old", DAY(2024, 1, 1), D(1)), ("old", DAY(2025, 1, 1), D(1))]
    opened = [("a", DAY(2023, 2, 21)), ("old", DAY(2022, 12, 1))]
    eras = [("a", DAY(2023, 2, 21)), ("old", DAY(2022, 12, 1))]
    # Opened before 2023-12 suits the current end, but 2022-12 is the limit at the base end.
    assert growth_of(rows, data, opened, eras)["2025-01"] == (50.0, 0.0, 1)
    assert growth_of(rows, data, opened, eras, both_ends=False)["2025-01"] == (50.0, 50.0, 2)


def test_conversion_leaves_the_base_for_two_years(rows):
    data = [("a", m, D(10)) for m in months(DAY(2024, 1, 1), 48)]
    eras = [("a", DAY(2018, 3, 20)), ("a", DAY(2025, 7, 1))]
    got = growth_of(rows, data, [("a", DAY(2018, 3, 20))], eras)
    excluded = sorted(m for m, v in got.items() if v[2] == 0)
    assert (excluded[0], excluded[-1], len(excluded)) == ("2025-07", "2027-06", 24)
    assert got["2025-06"][2] == got["2027-07"][2] == 1


def test_two_period_growth(rows):
    df = rows("unit string, d date, v decimal(9,2)",
              *[(u, DAY(y, 3, 1), D(v)) for u, y, v in [("a", 2025, 100), ("a", 2026, 110), ("new", 2026, 50),
                                                        ("conv", 2025, 100), ("conv", 2026, 50)]])
    opened = rows("unit string, open_date date", ("a", DAY(2015, 1, 1)), ("new", DAY(2025, 9, 16)),
                  ("conv", DAY(2018, 1, 1)))
    eras = rows("unit string, valid_from date", ("a", DAY(2015, 1, 1)), ("new", DAY(2025, 9, 16)),
                ("conv", DAY(2018, 1, 1)), ("conv", DAY(2025, 7, 1)))
    got = growth.two_period_growth(df, opened, eras, "unit", "d", "v", ("2026-01-01", "2026-06-30"),
                                   ("2025-01-01", "2025-06-30"))
    assert values(got) == [(5.0, 10.0, 1)]


# ---- cost ratios

def test_ratio_vs_target_without_a_plan_row(rows):
    totals = rows("u string, month_start date, net decimal(9,2), c decimal(9,2), w decimal(9,2)",
                  ("a", DAY(2025, 1, 1), D(100), D(40), D(23)), ("a", DAY(2025, 2, 1), D(100), D(40), D(23)),
                  ("b", DAY(2025, 1, 1), D(100), D(40), D(21)), ("z", DAY(2025, 1, 1), D(-5), D(40), D(23)))
    plan = rows("u string, month_start date, n decimal(9,2), c decimal(9,2), w decimal(9,2)",
                ("a", DAY(2025, 2, 1), D(200), D(60), D(60)))
    got = costs.ratio_vs_target(totals, plan, "u", "net", ["c", "w"], "n", ["c", "w"], 60, 2)
    assert values(got) == [("a", "2025-01", 63.0, None, None, True), ("a", "2025-02", 63.0, 60.0, 3.0, False)]
    first = got.orderBy(F.col("miss_pts").desc_nulls_first()).first()
    assert first.no_plan_row


def test_absent_cost_series_counts_zero_and_nothing_fans_out(rows):
    net = rows("u string, m int, net decimal(9,2)", ("a", 1, D(10)), ("a", 2, D(10)))
    bought = rows("u string, m int, p decimal(9,2)", ("a", 1, D(3)), ("x", 1, D(9)))
    worked = rows("u string, m int, l decimal(9,2)", ("a", 2, D(4)))
    assert values(costs.with_costs(net, [bought, worked], ["u", "m"])) == \
        [("a", 1, D(10), D(3), D(0)), ("a", 2, D(10), D(0), D(4))]


def test_price_steps_are_inclusive_and_use_the_previous_observed_month(rows):
    df = rows("v string, d date, p decimal(9,4)", ("x", DAY(2025, 1, 5), D(100)), ("x", DAY(2025, 2, 5), D(102)),
              ("x", DAY(2025, 2, 9), D(104)), ("x", DAY(2025, 4, 1), D(105)))
    assert values(costs.price_steps(df, ["v"], "d", "p", 0.03)) == [("x", "2025-02", 100.0, 103.0, 3.0)]


def test_overlapping_windows_and_pairs(rows):
    df = rows("u string, d date, n decimal(9,2), p decimal(9,2)", ("a", DAY(2025, 1, 1), D(10), D(5)),
              ("a", DAY(2025, 3, 1), D(10), D(8)), ("b", DAY(2025, 3, 1), None, D(8)))
    sums = costs.window_sums(df, ["u"], "d", ["p", "n"], {"pre": ("2025-01-01", "2025-03-31"),
                                                          "post": ("2025-03-01", "2025-03-31")})
    assert values(costs.ratio_in_windows(sums, "u", "p", "n", "pre", "post")) == [("a", 65.0, 80.0, 15.0)]


def test_cost_bridge_and_money(rows):
    df = rows("d date, n decimal(9,2), l decimal(9,2), p decimal(9,2)",
              (DAY(2024, 1, 6), D(100), D(30), D(20)), (DAY(2024, 1, 8), D(100), D(20), D(20)),
              (DAY(2025, 1, 4), D(100), D(60), D(30)), (DAY(2025, 1, 6), D(100), D(20), D(30)))
    got = costs.cost_bridge(df, "d", "n", "l", "p", {"base": ("2024-01-01", "2024-12-31"),
                                                     "now": ("2025-01-01", "2025-12-31")})
    assert {r.line: (r.base, r.now, r.delta_pts) for r in got.collect()} == {
        "total cost, % of net": (45.0, 70.0, 25.0), "labor leg": (25.0, 40.0, 15.0),
        "labor leg, weekend": (30.0, 60.0, 30.0), "labor leg, weekday": (20.0, 20.0, 0.0),
        "purchases leg": (20.0, 30.0, 10.0)}
    miss = costs.target_miss(df, "d", "n", ["l", "p"], ("2025-01-01", "2025-12-31"), 60)
    assert values(miss) == [(70.0, 10.0, 200.0, 20.0)]


def test_mean_change(rows):
    df = rows("d date, v decimal(9,4)", (DAY(2025, 2, 1), D(4)), (DAY(2025, 2, 28), D(6)), (DAY(2025, 3, 31), D(6)),
              (DAY(2025, 4, 1), D(99)))
    assert values(costs.mean_change(df, "d", "v", "2025-03-01", "2025-02-01")) == [(20.0,)]


# ---- streaks

def flags_of(rows, text, skip=()):
    start = DAY(2025, 1, 6)
    data = [("a", start + dt.timedelta(weeks=i), c == "T") for i, c in enumerate(text) if i not in skip]
    return rows("unit string, week_start date, over boolean", *data)


def test_an_unflagged_week_splits_a_streak(rows):
    flags = flags_of(rows, "TTTTFTTTTT")
    for mode in ("calendar", "observed"):
        got = streaks.streaks(flags, "unit", consecutive=mode)
        assert sorted(r.weeks for r in got.collect()) == [4, 5]
    short = streaks.streaks(flags_of(rows, "TTFTTT"), "unit", min_weeks=2)
    assert values(short, "weeks", "streak_start") == [(2, DAY(2025, 1, 6)), (3, DAY(2025, 1, 27))]


def test_an_absent_week_splits_in_calendar_mode_only(rows):
    flags = flags_of(rows, "TTTTTTTTT", skip={4})
    assert sorted(r.weeks for r in streaks.streaks(flags, "unit").collect()) == [4, 4]
    assert [r.weeks for r in streaks.streaks(flags, "unit", consecutive="observed").collect()] == [8]
    with pytest.raises(ValueError):
        streaks.streaks(flags, "unit", consecutive="sometimes")


def test_rolling_flag_needs_a_full_window_and_positive_net(rows):
    week = [DAY(2025, 1, 6) + dt.timedelta(weeks=i) for i in range(5)]
    weekly = rows("unit string, week_start date, n decimal(9,2), c decimal(9,2), l decimal(9,2)",
                  *[("a", w, D(10), D(5), D(c)) for w, c in zip(week, (1, 1, 1, 2, 9))],
                  *[("b", w, D(-1), D(5), D(1)) for w in week])
    got = streaks.rolling_flags(weekly, "unit", "n", ["c", "l"], 62.0)
    assert values(got) == [("a", week[3], True), ("a", week[4], True)]
    assert values(streaks.rolling_flags(weekly, "unit", "n", ["c", "l"], 62.5)) == \
        [("a", week[3], False), ("a", week[4], True)]


# ---- reconciliation

def test_duplicate_inflation_counts_the_month_once(rows):
    keyed = rows("u string, m string, copies bigint, all_value decimal(9,2), kept_value decimal(9,2), net decimal(9,2)",
                 ("a", "2025-01", 2, D(10), D(5), D(5)), ("a", "2025-01", 2, D(14), D(7), D(7)),
                 ("a", "2025-01", 1, D(88), D(88), D(88)), ("b", "2025-01", 1, D(1), D(1), D(1)))
    assert values(reconcile.duplicate_impact(keyed, "u", "m")) == [("a", "2025-01", 2, D(12), 12.0)]


BOOK_A = [("a", DAY(2025, 1, d), D(v)) for d, v in [(1, 100), (2, 100), (3, 100), (4, 100), (5, 100)]]
BOOK_B = [("a", DAY(2025, 1, d), D(v)) for d, v in [(1, 100), (2, 0), (3, 103), (4, 90), (5, 120), (6, 50)]]


def test_tie_out_buckets_and_one_sided_days(rows):
    left = rows("u string, d date, x decimal(9,2)", *BOOK_A)
    right = rows("u string, d date, y decimal(9,2)", *BOOK_B)
    books = reconcile.two_books(left, right, ["u", "d"], "x", "y")
    got = {r.d.day: r.bucket for r in reconcile.tie_out_exceptions(books, "u", "d").collect()}
    assert got == {2: "b_missing_day", 3: "rounding", 4: "b_under_a", 5: "b_over_a", 6: "b_over_a"}
    inner = reconcile.two_books(left, right, ["u", "d"], "x", "y", how="inner")
    assert values(reconcile.tied_days(inner, "u")) == [("a", 1, 4)]
    assert values(reconcile.tied_days(books, "u")) == [("a", 1, 5)]


def test_deposit_shift_is_named(rows):
    left = rows("u string, d date, x decimal(9,2)", *BOOK_A[:3])
    right = rows("u string, d date, y decimal(9,2)", ("a", DAY(2025, 1, 1), D(0)), ("a", DAY(2025, 1, 2), D(200)),
                 ("a", DAY(2025, 1, 3), D(0)))
    books = reconcile.two_books(left, right, ["u", "d"], "x", "y")
    plain = reconcile.tie_out_exceptions(books, "u", "d")
    assert [v[1] for v in values(plain, "d", "bucket")] == ["b_missing_day", "b_over_a", "b_missing_day"]
    named = reconcile.tie_out_exceptions(books, "u", "d", detect_shift=True)
    assert [v[1] for v in values(named, "d", "bucket")] == ["shifted", "shifted", "b_missing_day"]


# ---- mix

def test_percentiles_against_a_sorted_list(rows):
    rng = random.Random(5)
    data = {"flat": [7.0] * 40, "two": [1.0, 2.0], "one": [-3.5], "wide": [rng.uniform(-1e9, 1e9) for _ in range(301)],
            "tiny": [rng.uniform(0, 1e-7) for _ in range(50)], "near": [1000 + i / 1000 for i in range(98)],
            "hot": [5.0] * 500 + [float(i) for i in range(100)], "zero": [0.0, -1.0, 1.0, 0.0]}
    df = rows("g string, v double, w double", *[(g, v, -v) for g, vs in data.items() for v in vs], ("flat", None, None))
    for p in (0.5, 0.25, 0.9, 0.0, 1.0):
        spread = {r.g: (r.v, r.w) for r in group_percentile(df, ["g"], ["v", "w"], p).collect()}
        gathered = {r.g: (r.v, r.w) for r in df.groupBy("g").agg(
            F.percentile("v", p).alias("v"), F.percentile("w", p).alias("w")).collect()}
        assert spread.keys() == gathered.keys() == data.keys()
        for g in data:
            assert spread[g] == pytest.approx(gathered[g], rel=1e-12, abs=1e-12)
    medians = {r.g: r.v for r in group_percentile(df, ["g"], ["v"]).collect()}
    assert medians == pytest.approx({g: statistics.median(v) for g, v in data.items()})


ITEMS = [("m", "a", 1, D("10.00"), D("4.00")), ("m", "b", 2, D("10.00"), D("4.00")),
         ("m", "c", 3, D("10.00"), D("9.00")), ("m", "d", 4, D("10.00"), None)]


def test_percentiles_of_100000_close_values(spark):
    df = spark.range(100_001).select((0.4 + F.col("id") / 1e9).alias("v"), F.lit("g").alias("g")).repartition(7)
    for p in (0.5, 0.01, 0.999):
        got = group_percentile(df, ["g"], ["v"], p).first().v
        assert got == df.agg(F.percentile("v", p)).first()[0]


def test_quadrants_use_group_medians_and_impute_missing_costs(rows):
    sold = rows("cat string, item string, units bigint, price decimal(9,2), cost decimal(9,2)", *ITEMS)
    got = mix.quadrants(sold, ["cat"], "item", "units", "price", "cost")
    # Median units 2.5, imputed cost 0.4 x 10, margins 6 12 3 24, median margin 9.
    assert values(got, "item", "margin", "quadrant", "cost_imputed") == [
        ("a", 6.0, "dog", False), ("b", 12.0, "puzzle", False), ("c", 3.0, "plowhorse", False),
        ("d", 24.0, "star", True)]


def test_at_the_median_counts_as_high(rows):
    sold = rows("cat string, item string, units bigint, price decimal(9,2), cost decimal(9,2)",
                *ITEMS[:3])
    got = {r.item: r.quadrant for r in mix.quadrants(sold, ["cat"], "item", "units", "price", "cost").collect()}
    assert got == {"a": "puzzle", "b": "star", "c": "plowhorse"}


def test_fold_labels(rows):
    df = rows("c string", ("Bar",), ("Mains",)).withColumn("c", mix.fold_labels("c", {"Bar": "Drinks"}))
    assert values(df) == [("Drinks",), ("Mains",)]


def test_top_ties_go_to_the_smaller_name(rows):
    df = rows("u string, i string, q int", *[("a", i, 5) for i in "dcba"], ("a", "e", 3), ("a", "e", 3))
    assert values(mix.top_per_group(df, ["u"], "i", "q", 3), "rn", "i", "units") == [(1, "e", 6), (2, "a", 5), (3, "b", 5)]
    assert values(metrics.top_n(df, "i", "q", 2)) == [("a", 5), ("e", 6)]


def test_band_shares_sum_to_100_and_lonely_units_have_no_peers(rows):
    df = rows("u string, f string, b string, v decimal(9,2)", ("a", "x", "am", D(25)), ("a", "x", "pm", D(75)),
              ("b", "x", "am", D(80)), ("b", "x", "pm", D(20)), ("c", "y", "am", D(1)), ("c", "y", "pm", D(99)))
    grid = mix.band_grid(df, ["u", "f"], "b", "v")
    shares = mix.band_shares(grid, "u", "b", ["am"]).collect()
    assert {(r.u, r.b): (r.band_order, r.share_pct) for r in shares}["a", "pm"] == (2, 75.0)
    totals = {u: sum(r.share_pct for r in shares if r.u == u) for u in "abc"}
    assert totals == {"a": 100.0, "b": 100.0, "c": 100.0}
    assert values(mix.below_peers(grid, "u", "f", "b", 0.5)) == [("a", "am", 25.0, 80.0), ("b", "pm", 20.0, 75.0)]


def test_era_reports(rows):
    eras = rows("u string, code string, valid_from date, valid_to date", ("a", "A1", DAY(2025, 1, 1), DAY(2025, 1, 2)),
                ("a", "A2", DAY(2025, 1, 3), None))
    df = rows("u string, day date, v decimal(9,2), b string", ("a", DAY(2025, 1, 1), D(10), "x"),
              ("a", DAY(2025, 1, 2), D(10), "y"), ("a", DAY(2025, 1, 3), D(40), "x"), ("a", DAY(2025, 1, 3), D(10), "y"))
    assert values(mix.era_band(df, eras, "u", "day", "v", F.col("b") == "x", "code")) == \
        [("A1", 5.0, 50.0), ("A2", 40.0, 80.0)]
    assert values(mix.era_totals(df, eras, "u", "day", "v", ["code"])) == [("A1", 10.0, 20.0, 2), ("A2", 50.0, 50.0, 1)]


# ---- hierarchy

NODES = [("a", "P"), ("b", "P"), ("c", "Q"), ("P", "group"), ("Q", "group"), ("group", None)]
WANT = [("P", D(3), 2), ("Q", D(4), 1), ("a", D(1), 1), ("b", D(2), 1), ("c", D(4), 1), ("group", D(7), 3)]


def test_rollup_by_walking_and_by_levels(rows):
    nodes = rows("node string, parent string", *NODES)
    leaves = rows("unit string, v decimal(9,2)", ("a", D(1)), ("b", D(1)), ("b", D(1)), ("c", D(4)))
    assert values(hierarchy.rollup_tree(leaves, "unit", "v", nodes)) == sorted(WANT)
    levels = leaves.join(nodes, leaves.unit == nodes.node)
    assert values(hierarchy.rollup_levels(levels, ["unit", "parent"], "v")) == sorted(WANT)


def test_ragged_depth(rows):
    nodes = rows("node string, parent string", ("top", None), ("x", "top"), ("y", "x"), ("z", "y"), ("w", "top"))
    leaves = rows("unit string, v decimal(9,2)", ("z", D(1)), ("w", D(2)), ("x", D(5)))
    got = {r.node: (int(r.net_sales), r.leaves) for r in hierarchy.rollup_tree(leaves, "unit", "v", nodes).collect()}
    assert got == {"top": (8, 3), "x": (6, 2), "y": (1, 1), "z": (1, 1), "w": (2, 1)}


def test_month_start_is_a_date(rows):
    assert values(rows("d date", (DAY(2025, 3, 31),)).select(month_start("d"))) == [(DAY(2025, 3, 1),)]


def test_ancestors_of_a_long_chain_and_of_a_cycle(rows):
    chain = rows("node int, parent int", *[(i, i + 1) for i in range(150)], (150, None))
    assert hierarchy.ancestors(chain).count() == 151 * 152 // 2
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.ancestors(rows("node int, parent int", (1, 2), (2, 3), (3, 1)))
