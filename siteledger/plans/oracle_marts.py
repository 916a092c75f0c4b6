"""DuckDB statements for the questions over several marts."""

from __future__ import annotations

from .models import ACCEPTED, MART_KEYS, REFERENCES, REQUIRED, UNIQUE
from .oracle_base import PIECES, statement
from .oracle_models import MODEL_SQL
from .oracle_questions import QUESTION_SQL

PIECES.update({
    # Net, purchases and wages by location, each at its own date.
    "m_net": ("""
        SELECT loc, day, sum(CASE st WHEN 'sale' THEN q * ranked.price - off WHEN 'refund' THEN q * ranked.price
                             ELSE 0 END) AS net
        FROM ranked WHERE seq = 1 AND p_name NOT LIKE '%anvil' GROUP BY ALL""", ("ranked",)),
    "m_buy": ("""
        SELECT loc, last_day(CAST(date_trunc('quarter', day) + INTERVAL 2 MONTH AS DATE)) AS day,
            CAST(sum(cents) AS DECIMAL(38,2)) / 100 AS purchases FROM inv GROUP BY ALL""", ("inv",)),
    "m_pay": ("""
        SELECT loc, CASE WHEN day(day) <= 15 THEN CAST(date_trunc('month', day) AS DATE) + 14 ELSE last_day(day) END AS day,
            sum(wages) AS labor FROM shift GROUP BY ALL""", ("shift",)),
    "m_all": ("""
        SELECT loc, day, CAST(net AS DOUBLE) AS net, CAST(NULL AS DOUBLE) AS purchases, CAST(NULL AS DOUBLE) AS labor FROM m_net
        UNION ALL SELECT loc, day, NULL, CAST(purchases AS DOUBLE), NULL FROM m_buy
        UNION ALL SELECT loc, day, NULL, NULL, CAST(labor AS DOUBLE) FROM m_pay""", ("m_net", "m_buy", "m_pay")),
    "m_month": ("""
        SELECT loc, CAST(date_trunc('month', day) AS DATE) AS m, coalesce(sum(net), 0) AS n,
            coalesce(sum(purchases), 0) AS p, coalesce(sum(labor), 0) AS l
        FROM m_all GROUP BY ALL""", ("m_all",)),
    "m_spine": ("""
        SELECT loc, unnest(generate_series(min(date_trunc('week', day)), max(date_trunc('week', day)), INTERVAL 7 DAY)) AS w
        FROM m_all GROUP BY loc""", ("m_all",)),
    "m_week": ("""
        SELECT s.loc, CAST(s.w AS DATE) AS w, coalesce(sum(net), 0) AS n, coalesce(sum(purchases), 0) AS p,
            coalesce(sum(labor), 0) AS l
        FROM m_spine s LEFT JOIN m_all a ON a.loc = s.loc AND date_trunc('week', a.day) = s.w GROUP BY ALL""",
        ("m_spine", "m_all")),
    "m_code": ("SELECT n_nationkey AS loc, code FROM era WHERE d2 IS NULL", ("era",)),
})

MART_SQL = {
    "m_a05_ratio_vs_target": statement("""
        WITH x AS (SELECT m_month.loc, m, 100 * (p + l) / m_month.n AS act, b.loc IS NULL AS no_plan_row,
                b.k / nullif(b.n, 0) * 100 AS tgt
            FROM m_month LEFT JOIN (SELECT loc, m, sum(n) AS n, sum(c + l) AS k FROM bud GROUP BY ALL) b USING (loc, m)
            WHERE round(m_month.n, 2) > 0)
        SELECT code AS location_code, strftime(m, '%Y-%m') AS month, round(act, 2) AS cost_pct,
            round(tgt, 2) AS target_pct, round(act - tgt, 2) AS miss_pts, no_plan_row
        FROM x JOIN m_code USING (loc) WHERE act - coalesce(tgt, 20) > 2""", "m_month", "bud", "m_code"),
    "m_a05_spine": statement("""
        SELECT loc AS location_id, w AS week_start, round(n, 2) AS net, round(p, 2) AS purchases, round(l, 2) AS labor
        FROM m_week""", "m_week"),
    "m_a08_streaks": statement("""
        WITH r AS (SELECT a.loc, a.w, sum(b.n) AS n, sum(b.p + b.l) AS k
            FROM m_week a JOIN m_week b ON b.loc = a.loc AND b.w BETWEEN a.w - INTERVAL 21 DAY AND a.w
            GROUP BY ALL HAVING count(*) = 4),
        f AS (SELECT loc, w FROM r WHERE round(n, 2) > 0 AND 100 * k / n > 12),
        o AS (SELECT loc, w, (SELECT max(s.w) FROM f s WHERE s.loc = f.loc AND s.w <= f.w AND NOT EXISTS (
                  SELECT 1 FROM f e WHERE e.loc = s.loc AND e.w = s.w - INTERVAL 7 DAY)) AS b FROM f)
        SELECT code AS location_code, b AS streak_start, max(w) AS streak_end, count(*) AS weeks
        FROM o JOIN m_code USING (loc) GROUP BY code, b HAVING count(*) >= 4""", "m_week", "m_code"),
    "m_a10b_ratio_in_windows": statement("""
        WITH w(e, d1, d2) AS (VALUES ('pre', DATE '1996-12-01', DATE '1997-02-28'),
                                     ('post', DATE '1999-09-01', DATE '1999-11-30')),
        a AS (SELECT e, loc, sum(net) AS n FROM m_net JOIN w ON day BETWEEN d1 AND d2 GROUP BY ALL),
        c AS (SELECT e, loc, sum(purchases) AS p FROM m_buy JOIN w ON day BETWEEN d1 AND d2 GROUP BY ALL),
        x AS (SELECT loc, e, 100 * CAST(p AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0) AS v FROM a JOIN c USING (e, loc))
        SELECT code AS location_code, round(max(v) FILTER (e = 'pre'), 2) AS purchases_pct_pre,
            round(max(v) FILTER (e = 'post'), 2) AS purchases_pct_post,
            round(max(v) FILTER (e = 'post') - max(v) FILTER (e = 'pre'), 2) AS delta_pts
        FROM x JOIN m_code USING (loc) GROUP BY code""", "m_net", "m_buy", "m_code"),
    "m_a12a_cost_bridge": statement("""
        WITH w(e, d1, d2) AS (VALUES ('b', DATE '1996-01-01', DATE '1996-12-31'),
                                     ('t', DATE '2000-07-01', DATE '2001-06-30')),
        x AS (SELECT e, sum(net) AS n, sum(labor) AS l, sum(purchases) AS p,
                sum(net) FILTER (isodow(day) > 5) AS wn, sum(labor) FILTER (isodow(day) > 5) AS wl
              FROM m_all JOIN w ON day BETWEEN d1 AND d2 WHERE loc = 7 GROUP BY e),
        y AS (SELECT e, unnest([
                {'line': 'total cost, % of net', 'v': 100 * (l + p) / n},
                {'line': 'labor leg', 'v': 100 * l / n},
                {'line': 'labor leg, weekend', 'v': 100 * wl / wn},
                {'line': 'labor leg, weekday', 'v': 100 * (l - wl) / (n - wn)},
                {'line': 'purchases leg', 'v': 100 * p / n}]) AS z FROM x)
        SELECT b.z.line AS line, round(b.z.v, 2) AS baseline, round(t.z.v, 2) AS trailing,
            round(t.z.v - b.z.v, 2) AS delta_pts
        FROM y b JOIN y t ON t.z.line = b.z.line WHERE b.e = 'b' AND t.e = 't'""", "m_all"),
    "m_t09_ratio_in_band": statement("""
        SELECT loc AS location_id, m AS month_start, round(100 * (p + l) / n, 2) AS cost_pct
        FROM m_month WHERE round(n, 2) > 0 AND 100 * (p + l) / n NOT BETWEEN 5 AND 40""", "m_month"),
    "a10b_window_table": statement("""
        WITH d AS (SELECT n_name, day, sum(net) AS net, count(DISTINCT l_orderkey) AS k FROM s GROUP BY ALL)
        SELECT h.o_orderkey AS ticket, h.n_name AS unit, h.day AS first,
            CAST(h.day + CAST(h.o_orderkey % 90 AS INTEGER) AS DATE) AS last,
            CAST(sum(d.net) AS DOUBLE) AS net, CAST(sum(d.k) AS BIGINT) AS tickets
        FROM head h LEFT JOIN d ON d.n_name = h.n_name
            AND d.day BETWEEN h.day AND h.day + CAST(h.o_orderkey % 90 AS INTEGER)
        GROUP BY ALL""", "s", "head"),
}


def _checks() -> str:
    """One count for each declared check, by a statement of its own."""
    def count(check: str, what: str, source: str) -> str:
        return f"SELECT '{check}' AS check, {what} AS violations FROM {source}"

    parts = [count(f"grain {m}", "count(*)", f"(SELECT 1 FROM {m} GROUP BY {', '.join(k)} HAVING count(*) > 1)")
             for m, k in MART_KEYS.items()]
    parts += [count(f"not_null {m}.{c}", f"count(*) FILTER ({c} IS NULL)", m) for m, c in REQUIRED]
    parts += [count(f"unique {m}.{c}", "count(*)",
                    f"(SELECT 1 FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for m, c in UNIQUE]
    parts += [count(f"accepted {m}.{c}", f"count(*) FILTER ({c} NOT IN ({', '.join(repr(v) for v in values)}))", m)
              for (m, c), values in ACCEPTED.items()]
    parts += [count(f"reference {m}.{c}", "count(*)",
                    f"{m} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{c})")
              for m, c, p, k in REFERENCES]
    parts += [
        count("net rule sale refund", """count(*) FILTER (line_state IN ('sale', 'refund') AND abs(net_amount - gross_amount
            + CASE line_state WHEN 'sale' THEN discount_amount ELSE 0 END) > 0.001)""", "fact_ticket_line"),
        count("net rule void comp", "count(*) FILTER (line_state IN ('void', 'comp') AND net_amount <> 0)", "fact_ticket_line"),
        count("not_null staged business_date", "count(*) FILTER (day IS NULL)", "export"),
        count("alias map total", "count(DISTINCT keyed_name)",
              "export WHERE NOT EXISTS (SELECT 1 FROM alias WHERE lower(trim(alias)) = lower(trim(keyed_name)))"),
        count("books tie", "CAST(count(*) > 45 AS BIGINT)", """
            (SELECT location_id, business_date, sum(net_amount) AS a FROM fact_ticket_line GROUP BY ALL) s
            FULL JOIN fact_gl_day g USING (location_id, business_date)
            WHERE abs(coalesce(gl_net_sales, 0) - coalesce(a, 0)) > 0.001"""),
        count("cost ratio plausible", "count(*)", """
            (SELECT location_id, date_trunc('month', d) AS m, sum(n) AS n, sum(k) AS k FROM (
                SELECT location_id, business_date AS d, net_amount AS n, 0 AS k FROM fact_ticket_line
                UNION ALL SELECT location_id, invoice_date, 0, ext_cost FROM fact_invoice_line
                UNION ALL SELECT location_id, business_date, 0, wages FROM fact_labor_day) GROUP BY ALL)
            WHERE round(n, 2) > 0 AND 100 * k / n NOT BETWEEN 35 AND 90"""),
        count("codes conserved", "CAST(count(*) FILTER (code NOT IN (SELECT code FROM era)) > 0 AS BIGINT)", "export"),
        count("eras apart", "count(*)", """dim_location_history a JOIN dim_location_history b
            ON b.location_id = a.location_id AND b.valid_from > a.valid_from
            AND b.valid_from <= coalesce(a.valid_to, DATE '2999-01-01')"""),
    ]
    marts = ", ".join(f"{m} AS MATERIALIZED ({MODEL_SQL['model_' + m]})" for m in MART_KEYS)
    return statement(f"WITH {marts} " + " UNION ALL ".join(parts), "export", "alias", "era")


MART_SQL["t12_question_bank"] = " UNION ALL ".join(
    f"SELECT '{name}' AS question, CASE WHEN EXISTS (SELECT 1 FROM ({sql.strip()})) THEN 'rows' ELSE 'empty' END AS status"
    for name, sql in QUESTION_SQL.items())
MART_SQL["c10_skew_join"] = """
    SELECT s_nationkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL"""
MART_SQL["m_checks"] = _checks()
