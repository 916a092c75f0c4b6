"""Queries against their DuckDB statements, and what every query must hold."""

import checker
import pytest

from siteledger.llm.oracles import ORACLES
from siteledger.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_statement(spark, duck, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert checker.mismatch(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) is None


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_chat_format", "op7_exact_dedup", "op9_url_filters", "op12_secret_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
