"""Every named query against its own DuckDB statement."""

import os

import pytest

import checker
from siteledger.plans.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("SITELEDGER_TEST_DIR", "/root/testdata/sf0.001")
# Queries whose result may be empty at the smallest scale, which is fine for a check.
MAY_BE_EMPTY = {"t10_metric_bands", "t08_bounded_variance", "a08_streaks", "q22_mean_price"}


@pytest.fixture(scope="module")
def duck():
    return checker.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    problem = checker.mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name],
                               want_rows=name not in MAY_BE_EMPTY)
    assert problem is None
