"""Plans: what reaches the scan, what is shuffled, and that the published fact agrees."""

import io
import tempfile
from contextlib import redirect_stdout

import pytest

import checker
from siteledger.plans import bindings, feeds
from siteledger.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# May have no rows at the smallest scale, or do not read the fact.
NOT_COMPARED = {"a08_streaks", "q22_mean_price", "a03b_unmapped_names", "a03c_ambiguous_aliases"}


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["q21_share_before_after"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,NATION_5)" in plan
    pruned = plan_of(QUERIES["q05_total_net"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in pruned
    assert "o_totalprice" not in pruned and "p_name" not in pruned


def test_published_fact_gives_the_same_answers(spark):
    duck = checker.connect(SF_DIR)
    schema = bindings.publish_mart(spark, SF_DIR, "testmart", tempfile.mkdtemp(prefix="mart-"))
    spark.conf.set(bindings.MART_SETTING, schema)
    try:
        for name in sorted(n for n in ORACLES if n[0] in "aq"):
            if name in NOT_COMPARED:
                continue
            assert checker.mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None, name
    finally:
        spark.conf.unset(bindings.MART_SETTING)


@pytest.mark.parametrize("name", ["a01a_monthly_net", "a05_ratio_vs_target", "a07c_era_band", "a09a_tie_out",
                                  "a11b_hierarchy_suppliers", "c10_conform_code", "q19_ratio_ranking",
                                  "t04_relationships", "model_fact_ticket_line"])
def test_same_answers_when_nothing_can_be_broadcast(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF_DIR)
        plan = plan_of(df)
        assert "Broadcast" not in plan and "CartesianProduct" not in plan
        assert checker.mismatch(df, checker.connect(SF_DIR), ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_both_books_share_one_deduplication(spark):
    df = QUERIES["a09a_tie_out"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("row_number() windowspecdefinition") == 1 and "ReusedExchange" in final


def test_a_mart_answers_only_for_its_own_tables(spark):
    schema = bindings.publish_mart(spark, SF_DIR, "boundmart", tempfile.mkdtemp(prefix="mart-"))
    spark.conf.set(bindings.MART_SETTING, schema)
    try:
        QUERIES["q05_total_net"](spark, SF_DIR)
        with pytest.raises(ValueError, match="published from"):
            QUERIES["q05_total_net"](spark, "/root/testdata/sf0.01")
    finally:
        spark.conf.unset(bindings.MART_SETTING)


@pytest.mark.parametrize("name", ["q05_total_net", "q10_best_sellers", "q11_unit_months", "q12_flagged_tickets", "q17_growth",
                                  "q19_ratio_ranking", "q20_attach_half_year", "q22_mean_price", "q24_mean_change",
                                  "a11b_hierarchy", "a12a_cost_bridge"])
def test_other_tickets_lines_go_before_copies_are_ranked(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    # The rank filter stands above the semi-join with the restricted headers.
    assert 0 <= plan.find("row_number()") < plan.find("Join LeftSemi")


@pytest.mark.parametrize("name", ["m_a12a_cost_bridge", "m_a10b_ratio_in_windows"])
def test_mart_questions_on_windows_render_their_tickets_only(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    # In both facts made of lines the rank filter stands above the semi-join with the tickets of the windows.
    assert plan.count("Join LeftSemi") >= 2 and 0 <= plan.find("row_number()") < plan.find("Join LeftSemi")


def test_the_question_bank_derives_its_lines_once(spark, monkeypatch):
    read, table = [], bindings.table
    monkeypatch.setattr(bindings, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    found = {r["question"]: r["status"] for r in QUERIES["t12_question_bank"](spark, SF_DIR).collect()}
    assert read.count("lineitem") == 1 and read.count("customer") == 1
    assert set(found.values()) <= {"rows", "empty"}


def test_shared_facts_give_the_same_answers(spark):
    duck = checker.connect(SF_DIR)
    made = bindings.shared_facts(spark, SF_DIR)
    for name in sorted(n for n in ORACLES if n.startswith("q") and n not in NOT_COMPARED):
        with bindings.sharing(made):
            found = QUERIES[name](spark, SF_DIR)
        assert checker.mismatch(found, duck, ORACLES[name]) is None, name


def test_the_question_bank_outlives_facts_that_fail(spark, monkeypatch):
    def fail(*_):
        raise ValueError("no facts")

    monkeypatch.setattr(bindings, "shared_facts", fail)
    found = QUERIES["t12_question_bank"](spark, SF_DIR)
    assert checker.mismatch(found, checker.connect(SF_DIR), ORACLES["t12_question_bank"]) is None


def test_the_checks_render_the_lines_once(spark, monkeypatch):
    rendered, render = [], feeds.FEEDS["pos_ticket_lines"]
    monkeypatch.setitem(feeds.FEEDS, "pos_ticket_lines", lambda *args: rendered.append(1) or render(*args))
    assert dict(QUERIES["m_checks"](spark, SF_DIR).collect())["alias map total"] >= 0
    assert len(rendered) == 1
