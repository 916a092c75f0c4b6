import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger.operators import quality

DAY = dt.date


def test_column_checks_pass_and_fail(rows):
    df = rows("k int, s string", (1, "a"), (2, "b"), (2, None), (None, "z"))
    assert values(quality.not_null(df, "k"), "s") == [("z",)]
    assert values(quality.unique(df, "k")) == [(2, 2)]
    assert values(quality.accepted_values(df, "s", ["a", "b"])) == [("z", 1)]
    parent = rows("key int", (1,))
    assert values(quality.relationships(df, "k", parent, "key"), "k") == [(2,), (2,)]
    assert values(quality.expression_is_true(df, "k < 2"), "k") == [(2,), (2,)]
    clean = rows("k int, s string", (1, "a"), (2, None))
    for check in (quality.not_null(clean, "k"), quality.unique(clean, "k"), quality.grain(clean, ["k", "s"]),
                  quality.accepted_values(clean, "s", ["a"]), quality.relationships(clean, "k", clean, "k"),
                  quality.expression_is_true(clean, F.col("k") > 0)):
        assert not check.take(1)


def test_grain_counts_missing_key_parts_as_equal(rows):
    df = rows("a int, b int", (1, None), (1, None), (1, 2))
    assert values(quality.grain(df, ["a", "b"])) == [(1, None, 2)]


def test_bounds(rows):
    books = rows("variance decimal(9,2)", (D(1),), (D(0),), (D(-1),))
    assert values(quality.bounded_variance(books, 1)) == [(2,)]
    assert not quality.bounded_variance(books, 2).take(1)
    totals = rows("u string, net decimal(9,2), c decimal(9,2), w decimal(9,2)", ("low", D(100), D(30), D(4)),
                  ("edge", D(100), D(30), D(5)), ("high", D(100), D(90), D(1)), ("neg", D(-1), D(5), D(5)))
    assert values(quality.ratio_in_band(totals, ["u"], "net", ["c", "w"], 35, 90)) == [("high", 91.0), ("low", 34.0)]


def test_metric_bands(rows):
    metrics = rows("metric string, value double", ("miss", 4.2), ("gap", 7.9), ("free", 1.0))
    bands = {"miss": (4.0, 4.6), "gap": (8.0, None), "absent": (None, 1.0)}
    assert values(quality.metric_bands(metrics, bands), "metric", "value") == [("absent", None), ("gap", 7.9)]
    assert not quality.metric_bands(metrics, {"miss": (4.2, 4.2)}).take(1)


def test_results_match_by_position_and_rounded_values(rows):
    left = rows("n double, s string, d date", (1.0, "a ", DAY(2025, 1, 1)), (None, None, None))
    right = rows("other decimal(9,3), t string, e string", (None, None, None), (D("1.004"), "a", "2025-01-01"))
    assert not quality.diff_results(left, right).take(1)
    assert not quality.diff_results(left, left).take(1)


@pytest.mark.parametrize("schema,one,other", [
    ("x string", [("",)], [(None,)]),
    ("x int", [(1,), (1,)], [(1,)]),
    ("x double", [(1.0,)], [(1.01,)]),
    ("x string", [("a",)], [("A",)]),
])
def test_results_differ(rows, schema, one, other):
    assert quality.diff_results(rows(schema, *one), rows(schema, *other)).take(1)


def test_half_even_rounding_booleans_and_width(rows):
    assert not quality.diff_results(rows("x double", (0.125,)), rows("x double", (0.12,))).take(1)
    assert not quality.diff_results(rows("x double", (0.135,)), rows("x double", (0.14,))).take(1)
    assert quality.diff_results(rows("x boolean", (True,)), rows("x int", (1,))).count() == 2
    assert quality.diff_results(rows("x int, y int", (1, 2)), rows("x int", (1,))).count() == 2
    assert not quality.diff_results(rows("x int, y int", (1, 2)).limit(0), rows("x int", (1,)).limit(0)).take(1)


def test_order_matters_only_when_asked(rows):
    df = rows("k string, v int", ("a", 3), ("b", 2), ("c", 2), ("d", 1)).repartition(4)
    assert not quality.diff_results(df, df).take(1)
    assert not quality.diff_results(df, df, expected_order=["k"], actual_order=[F.desc("v"), "k"]).take(1)
    found = quality.diff_results(df, df, expected_order=["k"], actual_order=["v", "k"])
    assert {r.position for r in found.collect()} == {1, 4}
    with pytest.raises(ValueError):
        quality.diff_results(df, df, expected_order=["k"])


def test_positions_are_dense_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("v"))
    got = quality.positions(df, ["v"])
    assert got.filter("position <> v + 1").count() == 0 and got.count() == 5000


def test_all_non_empty(rows):
    df = rows("x int", (1,))
    assert values(quality.all_non_empty({"full": df, "empty": df.filter("x > 1")})) == [("empty",)]


def test_numbers_beyond_rounding_and_padded_text_compare(spark):
    def frame(*data):
        return spark.createDataFrame(list(data), "d double, w decimal(38,0), t string")
    most = D("9" * 38)
    one = frame((1e27, most, "\t a\u00a0"), (float("nan"), None, None), (float("inf"), D(1), ""))
    assert quality.diff_results(one, frame((1e27, most, "a"), (float("nan"), None, None), (float("inf"), D(1), " "))).count() == 0
    assert quality.diff_results(one, frame((2e27, most, "a"), (float("nan"), None, None), (float("-inf"), D(1), ""))).count() == 4
