import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger.functions import (backfill_ratio, band, blank_to_null, map_codes, parse_dates, pct,
                                  signed_net, title_label, to_local_ntz, week_start,
                                  weekday_window_flag)
from siteledger.plans.conforming import SERVICE_BANDS
from siteledger.plans.models import CATEGORY_LABELS, UOM_CODES


def column(df, expr):
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_parse_dates_three_formats_and_no_match(rows):
    df = rows("d string", ("2024-03-05",), ("03/05/2024",), ("3/5/2024",), ("2024/03/05",),
              ("05.03.2024",), (None,))
    assert column(df, parse_dates("d")) == [dt.date(2024, 3, 5)] * 4 + [None, None]


def test_impossible_date_fails_or_becomes_null(rows):
    df = rows("d string", ("13/45/2024",))
    with pytest.raises(Exception):
        column(df, parse_dates("d"))
    assert column(df, parse_dates("d", strict=False)) == [None]


def test_utc_text_becomes_local_wall_time(rows):
    df = rows("t string", ("2025-03-01T05:10:11Z",), ("2025-04-01T05:10:11Z",),
              ("2025-03-09T07:30:00Z",), ("2025-03-01 19:00:00",), (None,))
    assert column(df, to_local_ntz("t", "America/New_York")) == [
        dt.datetime(2025, 3, 1, 0, 10, 11), dt.datetime(2025, 4, 1, 1, 10, 11),
        dt.datetime(2025, 3, 9, 3, 30), dt.datetime(2025, 3, 1, 19, 0), None]


def test_blank_is_missing(rows):
    assert column(rows("x string", ("",), (" ",), ("a",), (None,)), blank_to_null("x")) == \
        [None, " ", "a", None]


def test_code_variants(rows):
    df = rows("u string", ("CS",), ("case",), ("Case",), ("lb",), (" ea ",), ("bag",), ("GAL",),
              ("keg",), (None,))
    assert column(df, map_codes("u", UOM_CODES)) == \
        ["CS", "CS", "CS", "LB", "EA", "BG", "GAL", "KEG", None]


def test_labels(rows):
    df = rows("r string", ("LINE COOK",), ("line cook",), ("Server ",), ("na beverages",),
              ("SIDES",), ("Starters ",), ("line-cook",), ("brunch & eggs",))
    assert column(df, title_label("r", CATEGORY_LABELS)) == [
        "Line Cook", "Line Cook", "Server", "NA Beverages", "Sides", "Starters", "Line-Cook",
        "Brunch & Eggs"]


def test_backfill_keeps_the_original_visible(rows):
    df = rows("c decimal(9,4), e decimal(12,2), q decimal(9,3)",
              (None, D("71.28"), D("3.000")), (None, D("71.28"), D("0.000")),
              (D("5.0000"), D("71.28"), D("3.000")))
    got = df.select("c", backfill_ratio("c", "e", "q").cast("decimal(9,4)").alias("f")).collect()
    assert [tuple(r) for r in got] == [(None, D("23.7600")), (None, None), (D("5.0000"), D("5.0000"))]


@pytest.mark.parametrize("clock,label", [
    ("06:59:00", "late_night"), ("07:00:00", "breakfast"), ("10:59:59", "breakfast"),
    ("11:00:00", "lunch"), ("14:59:00", "lunch"), ("15:00:00", "afternoon"),
    ("17:00:00", "dinner"), ("21:59:59", "dinner"), ("22:00:00", "late_night"),
    ("01:30:00", "late_night")])
def test_hour_bands(rows, clock, label):
    df = rows("t string", (f"2025-01-04 {clock}",))
    assert column(df, band(F.col("t").cast("timestamp_ntz"), SERVICE_BANDS, "late_night")) == [label]


def test_missing_time_takes_the_default_band_and_bands_wrap_midnight(rows):
    df = rows("t string", (None,), ("2025-01-04 23:10:00",), ("2025-01-04 03:10:00",))
    ts = F.col("t").cast("timestamp_ntz")
    assert column(df, band(ts, SERVICE_BANDS, "late_night")) == ["late_night"] * 3
    assert column(df, band(ts, [("night", 22, 1)], "day")) == ["day", "night", "day"]


def test_weekday_window(rows):
    df = rows("d string, t string", ("2025-01-04", "2025-01-04 10:00:00"),
              ("2025-01-04", "2025-01-04 14:59:00"), ("2025-01-04", "2025-01-04 15:00:00"),
              ("2025-01-03", "2025-01-03 12:00:00"))
    flag = weekday_window_flag(F.col("d").cast("date"), F.col("t").cast("timestamp_ntz"), (6, 7), 10, 14)
    assert column(df, flag) == [True, True, False, False]


def test_signed_net(rows):
    df = rows("s string, q int, p decimal(9,2), d decimal(9,2)",
              ("sale", 2, D("10.00"), D("3.00")), ("refund", -1, D("10.00"), D("0.00")),
              ("void", 2, D("10.00"), D("0.00")), ("comp", 2, D("10.00"), D("0.00")),
              ("sale", -3, D("12.00"), D("0.00")), ("sale", 1, D("20.00"), D("250.00")))
    assert column(df, signed_net("s", "q", "p", "d")) == [
        D("17.00"), D("-10.00"), D("0.00"), D("0.00"), D("-36.00"), D("-230.00")]


def test_ratio_guards_zero_and_weeks_start_on_monday(rows):
    df = rows("a decimal(9,2), b decimal(9,2), d string", (D("1.00"), D("0.00"), "2025-01-05"),
              (D("1.00"), D("8.00"), "2025-01-06"))
    assert column(df, pct("a", "b", 1)) == [None, 12.5]
    assert column(df, week_start(F.col("d").cast("date"))) == [dt.date(2024, 12, 30), dt.date(2025, 1, 6)]


def test_values_helper_sorts_missing_first(rows):
    assert values(rows("a int", (2,), (None,))) == [(None,), (2,)]
