"""DuckDB statements for the question bank."""

from __future__ import annotations

from .oracle_base import statement

_Y97 = "year(day) = 1997"

QUESTION_SQL = {
    "q01_count_units": statement("SELECT count(*) AS units FROM place WHERE r_name = 'ASIA'", "place"),
    "q02_list_units": statement("""
        SELECT n_name AS unit, n_nationkey AS unit_id FROM place WHERE r_name = 'EUROPE'""", "place"),
    "q03_item_price": "SELECT p_retailprice AS price FROM part WHERE p_partkey = 25",
    "q04_count_items": "SELECT count(*) AS items FROM part WHERE p_type = 'MEDIUM'",
    "q05_total_net": statement(
        f"SELECT CAST(sum(net) AS DOUBLE) AS net_sales FROM s WHERE {_Y97}", "s"),
    "q06_suppliers_of": """
        SELECT s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_3'""",
    "q07_items_without_cost": "SELECT p_partkey AS part, p_name AS item_name FROM part WHERE p_partkey % 29 = 0",
    "q08_net_by_area": statement(f"""
        SELECT r_name AS area, CAST(round(sum(net), 2) AS DOUBLE) AS net_sales FROM s WHERE {_Y97} GROUP BY ALL""", "s"),
    "q09_average_ticket": statement(f"""
        SELECT n_name AS unit, round(CAST(sum(net) AS DOUBLE) / count(DISTINCT l_orderkey), 2) AS average_ticket
        FROM s WHERE {_Y97} GROUP BY ALL""", "s"),
    "q10_best_sellers": statement("""
        SELECT l_partkey AS part, CAST(sum(qty) AS BIGINT) AS units FROM s
        WHERE state = 'sale' AND year(day) = 1996 GROUP BY ALL ORDER BY units DESC, part LIMIT 5""", "s"),
    "q11_unit_months": statement(f"""
        SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(net) AS DOUBLE) AS net_sales
        FROM s WHERE n_name = 'NATION_5' AND {_Y97} GROUP BY ALL""", "s"),
    "q12_flagged_tickets": statement(f"""
        WITH t AS (SELECT n_name, l_orderkey, bool_or(pieces >= 45) AS f FROM s WHERE {_Y97} GROUP BY ALL)
        SELECT n_name AS unit, round(100.0 * count(*) FILTER (f) / count(*), 1) AS large_pct FROM t GROUP BY ALL""", "s"),
    "q13_comp_value": statement(f"""
        SELECT n_name AS unit, CAST(round(sum(worth), 2) AS DOUBLE) AS comp_value FROM s
        WHERE state = 'comp' AND {_Y97} GROUP BY ALL""", "s"),
    "q14_over_plan": statement(f"""
        WITH a AS (SELECT n_name, CAST(date_trunc('month', day) AS DATE) AS m, sum(labor) AS l FROM s
                   WHERE {_Y97} GROUP BY ALL)
        SELECT n_name AS unit, m AS month_start, round(CAST(l AS DOUBLE) - p_labor, 2) AS over_plan
        FROM a JOIN plan USING (n_name, m) ORDER BY CAST(l AS DOUBLE) - p_labor DESC LIMIT 5""", "s", "plan"),
    "q15_weekend_share": statement(f"""
        SELECT n_name AS unit, round(100.0 * CAST(sum(net) FILTER (WHERE dayofweek(day) IN (0, 6)) AS DOUBLE)
            / CAST(sum(net) AS DOUBLE), 1) AS weekend_pct FROM s WHERE {_Y97} GROUP BY ALL""", "s"),
    "q16_top_three_quarter": statement("""
        WITH q AS (SELECT n_name, l_partkey, sum(qty) AS u FROM s WHERE state = 'sale' AND year(day) = 1997
                   AND month(day) > 9 GROUP BY ALL)
        SELECT n_name AS unit, l_partkey AS part, CAST(u AS BIGINT) AS units FROM q
        QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY u DESC, l_partkey) <= 3""", "s"),
    "q17_growth": statement("""
        SELECT n_name AS unit, round(100.0 * (CAST(sum(net) FILTER (WHERE year(day) = 1998) AS DOUBLE)
            / nullif(CAST(sum(net) FILTER (WHERE year(day) = 1997) AS DOUBLE), 0) - 1), 1) AS growth_pct
        FROM s WHERE year(day) <= 1998 GROUP BY ALL""", "s"),
    "q18_differing_days": statement("""
        SELECT unit, count(*) FILTER (WHERE a <> b) AS variance_days
        FROM book_a JOIN book_b USING (unit, day) WHERE year(day) = 1998 GROUP BY unit""", "book_a", "book_b"),
    "q19_ratio_ranking": statement("""
        SELECT n_name AS unit, round(100.0 * CAST(sum(purchases) + sum(labor) AS DOUBLE)
            / CAST(sum(net) AS DOUBLE), 2) AS cost_pct
        FROM c WHERE day BETWEEN DATE '2000-07-01' AND DATE '2001-06-30' GROUP BY ALL""", "c"),
    "q20_attach_half_year": statement("""
        WITH t AS (SELECT n_name, l_orderkey, bool_or(p_type = 'PROMO') AS f FROM c
                   WHERE state = 'sale' AND year(day) = 2000 AND month(day) <= 6 GROUP BY ALL)
        SELECT n_name AS unit, round(100.0 * count(*) FILTER (f) / count(*), 1) AS attach_pct FROM t GROUP BY ALL""", "c"),
    "q21_share_before_after": statement("""
        SELECT CASE WHEN year(day) < 1998 THEN 'before' ELSE 'after' END AS era,
            round(100.0 * CAST(sum(order_value) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE)
                  / CAST(sum(order_value) AS DOUBLE), 1) AS urgent_pct
        FROM head WHERE n_name = 'NATION_5' GROUP BY 1""", "head"),
    "q22_mean_price": statement("""
        WITH p AS (SELECT strftime(day, '%Y-%m') AS month,
                sum((2 * CAST(worth * 100 AS HUGEINT) * 100 + pieces) // (2 * pieces)) AS t, CAST(count(*) AS HUGEINT) AS n
            FROM c WHERE p_brand = 'Brand#7' AND state = 'sale' AND year(day) = 1998 AND month(day) IN (5, 7) GROUP BY ALL)
        SELECT month, CAST((2 * t + 100 * n) // (200 * n) AS DOUBLE) / 100 AS mean_price FROM p""", "c"),
    "q23_share_of_total": statement("""
        SELECT l_suppkey AS supplier, round(100.0 * CAST(sum(worth) AS DOUBLE)
            / CAST(sum(sum(worth)) OVER () AS DOUBLE), 1) AS share_pct FROM typed GROUP BY ALL""", "typed"),
    "q24_mean_change": statement("""
        WITH p AS (SELECT month(day) AS m,
                CAST(sum((2 * CAST(worth * 100 AS HUGEINT) * 100 + pieces) // (2 * pieces)) AS DOUBLE) / count(*) AS x
            FROM c WHERE p_brand = 'Brand#7' AND year(day) = 1998 AND month(day) IN (2, 3) GROUP BY ALL)
        SELECT round(100.0 * (max(x) FILTER (WHERE m = 3) / max(x) FILTER (WHERE m = 2) - 1), 1) AS change_pct FROM p""", "c"),
}
