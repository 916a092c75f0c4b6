import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger.functions import parse_dates
from siteledger.operators import calendar, cleaning, conform, quality
from siteledger.operators.drill import Fact, drill_across

DAY = dt.date


def test_strict_and_lenient_casts(rows):
    df = rows("a string, b string", ("1", "2.50"), ("x", "3.00"), (None, ""))
    with pytest.raises(Exception):
        cleaning.cast_columns(df, {"a": "int"}).collect()
    typed = cleaning.cast_lenient(df, {"a": "int", "b": "decimal(9,2)"}).collect()
    assert [r.bad_columns for r in typed] == [[], ["a"], ["b"]]
    assert [r.a for r in typed] == [1, None, None]
    assert values(cleaning.reject_rows(df, {"a": "int", "b": "decimal(9,2)"}), "a", "b") == \
        [(None, ""), ("x", "3.00")]


EXPORTS = [("A", 1, "2025-01-01 12:00:10", "x"), ("A", 1, "2025-01-01 12:01:40", "y"),
           ("A", 2, "2025-01-01 12:00:10", "p"), ("A", 2, "2025-01-01 12:00:10", "q"),
           ("B", 1, None, "n"), ("B", 1, "2025-01-01 09:00:00", "m")]


def test_keep_latest_is_a_total_order(rows):
    df = rows("loc string, line int, closed string, item string", *EXPORTS)
    want = [("A", 1, "y"), ("A", 2, "q"), ("B", 1, "m")]
    for frame in (df, df.repartition(5, "item"), df.orderBy(F.desc("item"))):
        kept = cleaning.keep_latest(frame, ["loc", "line"], ["closed"])
        assert values(kept, "loc", "line", "item") == want
        assert kept.columns == df.columns
    assert not quality.grain(cleaning.keep_latest(df, ["loc", "line"], ["closed"]), ["loc", "line"]).take(1)


def test_keep_latest_limits_each_task_before_the_shuffle(rows, capsys):
    df = rows("loc string, line int, closed string, item string", *EXPORTS)
    cleaning.keep_latest(df, ["loc", "line"], ["closed"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert "Partial" in plan[partial:]


def test_ranks_and_copies_agree_with_keep_latest(rows):
    df = rows("loc string, line int, closed string, item string", *EXPORTS)
    ranked = cleaning.rank_exports(df, ["loc", "line"], ["closed"])
    assert values(ranked.filter("export_seq = 1"), "loc", "line", "item") == \
        [("A", 1, "y"), ("A", 2, "q"), ("B", 1, "m")]
    grouped = cleaning.copies_and_latest(df, ["loc", "line"], ["closed"], ["item"],
                                         {"total": F.lit(10)})
    assert values(grouped, "loc", "line", "copies", "total", "item") == \
        [("A", 1, 2, 20, "y"), ("A", 2, 2, 20, "q"), ("B", 1, 2, 20, "m")]


def test_hot_keys_are_ranked_by_a_distributed_sort(spark, rows):
    data = [(k, i * 37 % 101, f"i{i}") for k, n in ((None, 90), ("hot", 101), ("cold", 3)) for i in range(n)]
    df = rows("loc string, closed int, item string", *data).repartition(6)
    spread = cleaning.rank_exports(df, ["loc"], ["closed"])
    assert dict(spread.dtypes)["export_seq"] == "int"
    for key, n in ((None, 90), ("hot", 101), ("cold", 3)):
        mine = sorted(((r.export_seq, r.closed) for r in spread.collect() if r["loc"] == key))
        assert [s for s, _ in mine] == list(range(1, n + 1))
        assert [c for _, c in mine] == sorted((c for _, c in mine), reverse=True)


def test_equal_copies_are_numbered_over_several_tasks(rows):
    df = rows("loc string, closed int", *[("a", 1)] * 3000).repartition(6)
    got = cleaning.rank_exports(df, ["loc"], ["closed"])
    assert sorted(r.export_seq for r in got.collect()) == list(range(1, 3001))


def test_salted_join_equals_the_plain_one(rows):
    aliases = rows("alias string, item_id int", ("Soup", 2), ("SOUP", 2), ("Tea", 3))
    lines = rows("name string, n int", *[("soup", i) for i in range(20)], ("tea", 1), ("mystery", 1))
    for how in ("inner", "left"):
        plain = conform.resolve_alias(lines, "name", aliases, how=how)
        assert values(conform.resolve_alias(lines, "name", aliases, how=how, salts=4)) == values(plain)
    with pytest.raises(ValueError):
        conform.salted_join(lines, aliases, "name", how="full_outer", salts=2)


def test_alias_variants_do_not_fan_out(rows):
    aliases = rows("alias string, item_id int", ("House Salad", 14), ("HOUSE SALAD", 14), ("Soup", 2))
    lines = rows("name string", ("house salad ",), ("Soup",), ("mystery",))
    assert values(conform.resolve_alias(lines, "name", aliases), "name", "item_id") == \
        [("Soup", 2), ("house salad ", 14)]
    assert values(conform.unmapped_names(lines, "name", aliases)) == [("mystery",)]
    assert values(quality.map_total(lines, "name", aliases)) == [("mystery",)]
    naive = lines.join(aliases, F.lower(F.trim("name")) == F.lower(F.trim("alias")))
    assert naive.count() == 3  # what the distinct prevents
    bad = rows("alias string, item_id int", ("Soup", 1), ("soup ", 2), ("Tea", 3))
    assert values(conform.ambiguous_aliases(bad)) == [("soup", 2)]


@pytest.fixture
def eras(rows):
    places = rows("location_code string, service_format string, open_date date, closed_date date",
                  ("GC", "full", DAY(2018, 3, 20), DAY(2025, 6, 30)),
                  ("GX", "counter", DAY(2025, 7, 1), None), ("WV", "full", DAY(2016, 5, 12), None))
    bridge = rows("location_code string, location_id int", ("GC", 3), ("GX", 3), ("WV", 1))
    return places, bridge


def test_current_dimension_and_history(eras):
    places, bridge = eras
    assert values(conform.current_dimension(places, bridge), "location_id", "location_code", "open_date") == \
        [(1, "WV", DAY(2016, 5, 12)), (3, "GX", DAY(2018, 3, 20))]
    history = conform.era_history(places, bridge, attributes=["service_format"])
    assert values(history, "location_id", "location_code", "valid_to") == \
        [(1, "WV", None), (3, "GC", DAY(2025, 6, 30)), (3, "GX", None)]
    assert not conform.overlapping_eras(history).take(1)


def test_era_ends_are_inside_and_open_ends_stay_open(rows, eras):
    history = conform.era_history(*eras)
    days = rows("location_id int, day date", (3, DAY(2018, 3, 20)), (3, DAY(2025, 6, 30)),
                (3, DAY(2025, 7, 1)), (3, DAY(2099, 1, 1)), (3, DAY(2017, 1, 1)))
    found = conform.in_era(days, history, "location_id", "day")
    assert values(found, "day", "location_code") == [
        (DAY(2018, 3, 20), "GC"), (DAY(2025, 6, 30), "GC"), (DAY(2025, 7, 1), "GX"), (DAY(2099, 1, 1), "GX")]


def test_overlap_is_found_across_a_short_era(rows):
    history = rows("location_id int, valid_from date, valid_to date",
                   (1, DAY(2020, 1, 1), DAY(2020, 12, 31)), (1, DAY(2020, 2, 1), DAY(2020, 2, 9)),
                   (1, DAY(2020, 6, 1), DAY(2020, 7, 1)), (1, DAY(2021, 1, 1), None))
    assert values(conform.overlapping_eras(history), "valid_from") == \
        [(DAY(2020, 2, 1),), (DAY(2020, 6, 1),)]


def test_unmapped_codes_drop_and_conservation_reports_them(rows, eras):
    lines = rows("location_code string, v int", ("GC", 1), ("GX", 2), ("ZZ", 3))
    kept = conform.conform_code(lines, eras[1], "location_code", "location_id")
    assert values(kept, "location_code", "location_id") == [("GC", 3), ("GX", 3)]
    assert values(quality.conservation(lines, kept)) == [(3, 2)]
    assert not quality.conservation(lines, lines).take(1)
    assert values(quality.conservation(lines, kept, ["location_code"])) == [("ZZ", 1, 0)]


def test_collapse_sums_label_variants(rows):
    df = rows("d string, role string, h int", ("x", "LINE COOK", 1), ("x", "line cook ", 2), ("x", "Server", 5))
    from siteledger.functions import title_label
    got = cleaning.collapse(df.withColumn("role", title_label("role")), ["d", "role"], ["h"])
    assert values(got) == [("x", "Line Cook", 3), ("x", "Server", 5)]


def test_calendar_rules(spark):
    cal = calendar.build_calendar(spark, "2024-01-01", "2026-12-31")
    days = {r.holiday_name: r.date_key for r in cal.filter("year = 2025 and is_holiday").collect()}
    assert cal.count() == 1096
    assert days["Easter Sunday"] == DAY(2025, 4, 20)
    assert days["Thanksgiving"] == DAY(2025, 11, 27)
    assert days["Thanksgiving Eve"] == DAY(2025, 11, 26)
    assert days["Memorial Day"] == DAY(2025, 5, 26)
    assert days["Mother's Day"] == DAY(2025, 5, 11)
    assert days["Super Bowl Sunday"] == DAY(2025, 2, 9)
    assert days["Marathon Sunday"] == DAY(2025, 11, 2)
    easter = [r.date_key for r in cal.filter("holiday_name = 'Easter Sunday'").orderBy("date_key").collect()]
    assert easter == [DAY(2024, 3, 31), DAY(2025, 4, 20), DAY(2026, 4, 5)]
    by_day = {r.date_key: r for r in cal.collect()}
    assert by_day[DAY(2024, 11, 28)].holiday_name == "Thanksgiving"
    assert by_day[DAY(2024, 5, 12)].holiday_name == "Mother's Day"
    assert by_day[DAY(2025, 4, 18)].is_school_break and not by_day[DAY(2025, 4, 21)].is_school_break
    assert by_day[DAY(2025, 2, 17)].is_school_break and by_day[DAY(2025, 2, 21)].is_school_break
    assert not by_day[DAY(2025, 2, 22)].is_school_break
    assert by_day[DAY(2025, 7, 22)].is_dining_week and not by_day[DAY(2025, 8, 9)].is_dining_week
    assert by_day[DAY(2025, 1, 4)].is_weekend and by_day[DAY(2025, 1, 4)].day_of_week == 6


def test_two_holidays_on_one_day(spark):
    day = calendar.build_calendar(spark, "2027-02-14", "2027-02-14").first()
    assert day.holiday_name == "Super Bowl Sunday"  # also Valentine's Day


def test_easter_over_two_centuries(spark):
    def anonymous(year):
        a, b, c = year % 19, year // 100, year % 100
        h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
        k = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
        m = (a + 11 * h + 22 * k) // 451
        return DAY(year, (h + k - 7 * m + 114) // 31, (h + k - 7 * m + 114) % 31 + 1)
    years = spark.range(1900, 2100).select(F.col("id").cast("int").alias("y"))
    got = years.select("y", calendar.easter_sunday(F.col("y")).alias("e")).collect()
    assert all(r.e == anonymous(r.y) for r in got)


def test_typed_calendar_blanks(rows):
    raw = rows("date_day string, year string, quarter string, month string, month_name string, "
               "day_of_week string, day_name string, is_weekend string, is_holiday string, "
               "holiday_name string, holiday_type string, is_school_break string, "
               "is_dining_week string, is_marathon_sunday string",
               ("2025-01-02", "2025", "1", "1", "January", "4", "Thursday", "false", "false", "", "",
                "true", "false", "false"))
    row = calendar.typed_calendar(raw).first()
    assert (row.date_key, row.holiday_name, row.holiday_type, row.is_school_break) == \
        (DAY(2025, 1, 2), None, None, True)


def test_copies_are_sorted_by_a_number_before_a_text(rows, capsys):
    df = rows("loc string, line int, closed string, item string", *EXPORTS).repartition(2)
    cleaning.keep_latest(df, ["loc", "line"], ["closed"]).explain()
    plan = capsys.readouterr().out
    assert "Sort [line#" in plan and "Sort [loc#" not in plan


def test_exports_are_made_once_and_cold_keys_need_no_overall_sort(rows, capsys):
    df = rows("loc int, closed int", *[(k, i) for k in range(300) for i in range(2)]).repartition(4)
    ranked = cleaning.rank_exports(df, ["loc"], ["closed"])
    assert sorted((r["loc"], r["closed"], r["export_seq"]) for r in ranked.collect()) == \
        [(k, i, 2 - i) for k in range(300) for i in range(2)]
    capsys.readouterr()
    ranked.explain()
    plan = capsys.readouterr().out
    assert "exports-" in plan and "rangepartitioning" not in plan and "ExistingRDD" not in plan


def test_rows_without_a_date_need_no_filter_below_the_facts(rows, capsys):
    fact = rows("k string, day string, v int", ("a", "2020-01-06", 1), ("a", None, 5), ("b", None, 7)).repartition(2)
    dated = fact.withColumn("day", parse_dates("day"))
    for grain in ("day", "week", "month", "quarter"):
        found = drill_across([Fact(dated, "day", {"v": "v"})], ["k"], grain)
        assert [(r["k"], r["v"]) for r in found.collect()] == [("a", 1)]
        found.explain()
        assert "isnotnull(CASE" not in capsys.readouterr().out


def test_dates_are_parsed_without_a_formatter(rows, capsys):
    texts = ["2020-02-29", "2/9/2020", "12/31/1999", "2020/03/01", "2021-02-29", "13/1/2020", "2020-1-2", "2020-01-01\n",
             "2020/01/01\n", "1/2/2020\n", "", None]
    days = rows("t string", *[(t,) for t in texts]).coalesce(1).select(parse_dates("t", strict=False).cast("string").alias("d"))
    assert [r["d"] for r in days.collect()] == ["2020-02-29", "2020-02-09", "1999-12-31", "2020-03-01", *[None] * 8]
    days.explain()
    assert "gettimestamp" not in capsys.readouterr().out
    for bad in ("2021-02-29", "2020-01-01\n", "1/2/2020\n"):
        with pytest.raises(Exception):  # noqa: B017
            rows("t string", (bad,)).select(parse_dates("t")).collect()
