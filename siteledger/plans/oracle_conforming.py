"""DuckDB statements for the cleaning, conforming, loading and checking queries."""

from __future__ import annotations

from .oracle_base import statement

# Holidays by looking up each year's dates, not by testing each day.
_CALENDAR = """
    WITH yrs AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
    e2 AS (SELECT y, a, c, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h,
               2 * (b % 4) + 2 * (c // 4) AS t FROM e1),
    e3 AS (SELECT y, a, h, (32 + t - h - c % 4) % 7 AS l FROM e2),
    e4 AS (SELECT y, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM e3),
    easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS d FROM e4),
    rule(pos, name, kind, mon, wd, nth) AS (VALUES
        (3, 'MLK Day', 'federal', 1, 1, 3), (4, 'Washington''s Birthday', 'federal', 2, 1, 3),
        (8, 'Labor Day', 'federal', 9, 1, 1), (9, 'Columbus Day', 'federal', 10, 1, 2),
        (11, 'Thanksgiving', 'federal', 11, 4, 4), (15, 'Mother''s Day', 'observance', 5, 7, 2),
        (16, 'Father''s Day', 'observance', 6, 7, 3), (20, 'Super Bowl Sunday', 'observance', 2, 7, 2),
        (21, 'Marathon Sunday', 'city_event', 11, 7, 1)),
    fixed(pos, name, kind, mon, dom) AS (VALUES
        (1, 'New Year''s Day', 'federal', 1, 1), (6, 'Juneteenth', 'federal', 6, 19),
        (7, 'Independence Day', 'federal', 7, 4), (10, 'Veterans Day', 'federal', 11, 11),
        (12, 'Christmas Day', 'federal', 12, 25), (13, 'Valentine''s Day', 'observance', 2, 14),
        (17, 'Halloween', 'observance', 10, 31), (19, 'New Year''s Eve', 'observance', 12, 31)),
    dated AS (
        SELECT pos, name, kind, make_date(y, mon, 1)
            + CAST((wd - isodow(make_date(y, mon, 1)) + 7) % 7 + 7 * (nth - 1) AS INTEGER) AS d FROM rule, yrs
        UNION ALL SELECT pos, name, kind, make_date(y, mon, dom) FROM fixed, yrs
        UNION ALL SELECT 14, 'Easter Sunday', 'observance', d FROM easter
        UNION ALL SELECT 5, 'Memorial Day', 'federal',
            make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) FROM yrs
        UNION ALL SELECT 18, 'Thanksgiving Eve', 'observance', make_date(y, 11, 1)
            + CAST((4 - isodow(make_date(y, 11, 1)) + 7) % 7 + 20 AS INTEGER) FROM yrs),
    hol AS (SELECT d, arg_max(name, pos) AS name, arg_max(kind, pos) AS kind FROM dated GROUP BY d),
    recess AS (SELECT d FROM dated WHERE name = 'Washington''s Birthday'),
    marathon AS (SELECT d FROM dated WHERE name = 'Marathon Sunday'),
    days AS (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))
                         AS DATE) AS d FROM orders)
    SELECT days.d AS date_key, CAST(year(days.d) AS INTEGER) AS year, CAST(quarter(days.d) AS INTEGER) AS quarter,
        CAST(month(days.d) AS INTEGER) AS month, monthname(days.d) AS month_name,
        CAST(isodow(days.d) AS INTEGER) AS day_of_week, dayname(days.d) AS day_name,
        isodow(days.d) IN (6, 7) AS is_weekend, hol.d IS NOT NULL AS is_holiday,
        hol.name AS holiday_name, hol.kind AS holiday_type,
        CASE WHEN days.d BETWEEN make_date(year(days.d), 6, 27) AND make_date(year(days.d), 9, 5) THEN true
             WHEN EXISTS (SELECT 1 FROM recess r WHERE days.d BETWEEN r.d AND r.d + 4) THEN true
             WHEN days.d BETWEEN DATE '2024-04-22' AND DATE '2024-04-30' THEN true
             WHEN days.d BETWEEN DATE '2025-04-14' AND DATE '2025-04-18' THEN true
             WHEN days.d BETWEEN DATE '2026-03-30' AND DATE '2026-04-03' THEN true
             WHEN year(days.d) IN (2024, 2025, 2026) THEN false END AS is_school_break,
        days.d BETWEEN make_date(year(days.d), 1, 16) AND make_date(year(days.d), 1, 31)
            OR days.d BETWEEN make_date(year(days.d), 7, 22) AND make_date(year(days.d), 8, 8) AS is_dining_week,
        days.d IN (SELECT d FROM marathon) AS is_marathon_sunday
    FROM days LEFT JOIN hol ON hol.d = days.d"""

CONFORMING_SQL = {
    "c01_parse_dates": """
        SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date FROM orders""",
    "c01_parse_dates_lenient": """
        SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 51 = 0 THEN NULL
            ELSE CAST(o_orderdate AS DATE) END AS order_date FROM orders""",
    "c02_local_time": statement("""
        SELECT event_id, strftime(local_ts, '%Y-%m-%d %H:%M:%S.%f') AS local_time FROM ev""", "ev"),
    "c03_cast_strict": "SELECT o_orderkey AS order_key, o_totalprice AS order_value FROM orders",
    "c03_cast_lenient": """
        SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 40 <> 0 THEN o_totalprice END AS order_value,
            CASE WHEN o_orderkey % 40 = 0 THEN 'order_value' ELSE '' END AS bad_columns FROM orders""",
    "c03_reject_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_key, 'n/a' AS order_value, 'order_value' AS bad_columns
        FROM orders WHERE o_orderkey % 40 = 0""",
    "c04_blank_to_null": statement("SELECT p_partkey AS part, unit_cost FROM item", "item"),
    "c05_map_codes": """
        SELECT o_orderkey AS order_key, CASE o_orderpriority WHEN '1-URGENT' THEN 'UR' WHEN '2-HIGH' THEN 'HI'
            WHEN '3-MEDIUM' THEN 'ME' ELSE o_orderpriority END AS code FROM orders""",
    "c06_title_label": """
        SELECT p_partkey AS part, CASE WHEN p_name = 'old ring' THEN 'OLD Ring' ELSE
            array_to_string(list_transform(string_split(p_name, ' '),
                lambda w: upper(w[1]) || w[2:]), ' ') END AS label FROM part""",
    "c07_backfill_ratio": statement("""
        SELECT l_orderkey AS ticket, l_linenumber AS line,
            CASE WHEN l_partkey % 7 <> 0 THEN pieces * 10.5::DOUBLE END AS unit_cost,
            CASE WHEN l_partkey % 7 <> 0 THEN pieces * 10.5::DOUBLE ELSE
                CAST((2 * CAST(worth * 100 AS HUGEINT) * 100 + pieces) // (2 * pieces) AS DOUBLE) / 10000
                END AS unit_cost_filled
        FROM typed""", "typed"),
    "c08_keep_latest": statement("""
        SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_partkey, l_suppkey,
            l_extendedprice AS price FROM kept""", "kept"),
    "c08_rank_exports": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC)
            AS INTEGER) AS export_seq FROM lineitem""",
    "c09_resolve_alias": statement("""
        SELECT p_partkey AS part, keyed_name, n.item_id FROM keyed
        JOIN (SELECT DISTINCT p_name, item_id FROM alias) n USING (p_name)""", "keyed", "alias"),
    "c10_conform_code": statement("""
        SELECT o_orderkey AS ticket, code AS location_code, era.n_nationkey AS location_id
        FROM head JOIN era ON era.n_nationkey = head.n_nationkey AND day BETWEEN d1 AND coalesce(d2, DATE '2999-01-01')""",
        "head", "era"),
    "c11_lookup_id": statement("""
        SELECT s_name, count(*) AS n_lines, s_suppkey FROM typed JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""",
        "typed"),
    "c12_era_history": statement("""
        SELECT n_nationkey AS location_id, code AS location_code, fmt AS service_format, d1 AS valid_from,
            d2 AS valid_to FROM era""", "era"),
    "c12_overlapping_eras": statement("""
        SELECT n_nationkey AS location_id, code AS location_code, DATE '1998-12-31' AS latest_end_before
        FROM era WHERE n_nationkey % 10 = 0 AND d2 IS NULL""", "era"),
    "c13_current_dimension": statement("""
        SELECT n_nationkey AS location_id, code AS location_code, n_name AS unit, fmt AS service_format,
            DATE '1995-01-01' AS open_date FROM era WHERE d2 IS NULL""", "era"),
    "c14_band": statement("""
        SELECT event_id, CASE WHEN hour(local_ts) IN (7,8,9,10) THEN 'breakfast'
            WHEN hour(local_ts) IN (11,12,13,14) THEN 'lunch' WHEN hour(local_ts) IN (15,16) THEN 'afternoon'
            WHEN hour(local_ts) IN (17,18,19,20,21) THEN 'dinner' ELSE 'late_night' END AS daypart FROM ev""", "ev"),
    "c15_weekday_window": statement("""
        SELECT event_id, dayname(local_ts) IN ('Saturday', 'Sunday')
            AND CAST(local_ts AS TIME) >= TIME '10:00:00' AND CAST(local_ts AS TIME) < TIME '15:00:00' AS is_brunch
        FROM ev""", "ev"),
    "c16_signed_net": statement("""
        SELECT l_orderkey AS ticket, l_linenumber AS line, state, CAST(CASE state WHEN 'sale' THEN worth - off
            WHEN 'refund' THEN -worth ELSE 0 END AS DOUBLE) AS net FROM typed""", "typed"),
    "c17_collapse": statement("""
        SELECT n_name AS unit, CASE o_orderpriority[1] WHEN '1' THEN '1-Urgent' WHEN '2' THEN '2-High'
            WHEN '3' THEN '3-Medium' WHEN '4' THEN '4-Not Specified' ELSE '5-Low' END AS priority, CAST(sum(order_value) AS DOUBLE) AS order_value
        FROM head GROUP BY ALL""", "head"),
    "c18_typed_calendar": _CALENDAR,
    "c19_build_calendar": _CALENDAR,
}

LOADING_SQL = {
    "s1_read_raw": """
        SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS order_value
        FROM orders""",
    "s2_land": """
        SELECT 'orders' AS "table", count(*) AS n_rows FROM orders
        UNION ALL SELECT 'customers', count(*) FROM customer""",
    "s3_publish": statement("""
        SELECT r_name AS area, count(*) AS tickets, CAST(sum(order_value) AS DOUBLE) AS value
        FROM head GROUP BY ALL""", "head"),
    "s4_sample_extract": statement("""
        SELECT o_orderkey AS ticket, day, n_name AS unit, CAST(order_value AS DOUBLE) AS order_value
        FROM head ORDER BY day, o_orderkey LIMIT 500""", "head"),
    "s5_fingerprint": """
        WITH c AS (SELECT md5(concat_ws('|', {cells})) AS h FROM lineitem)
        SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || h[1:15] AS BIGINT)) AS VARCHAR) || '-'
            || CAST(sum(CAST('0x' || h[16:30] AS BIGINT)) AS VARCHAR) AS digest FROM c""".format(cells=", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "CAST(l_quantity AS DECIMAL(18,4))",
            "CAST(l_extendedprice AS DECIMAL(18,4))", "CAST(l_discount AS DECIMAL(18,4))",
            "CAST(l_tax AS DECIMAL(18,4))", "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE)"))),
    "s5_verify": """
        SELECT 'suppliers' AS "table", 'contents differ' AS problem FROM supplier
        WHERE s_acctbal <> CASE s_suppkey WHEN 0 THEN s_acctbal + 1 ELSE s_acctbal END GROUP BY ALL
        UNION ALL SELECT 'orders', 'contents differ' FROM (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS k FROM orders) WHERE n < k
        UNION ALL SELECT * FROM (VALUES ('gone', 'table missing'), ('extra', 'not in manifest'))""",
    "s3_publish_table": statement("""
        SELECT r_name AS area, count(*) AS tickets, CAST(sum(order_value) AS DOUBLE) AS value
        FROM head GROUP BY ALL""", "head"),
    "s3_replace_all": statement("""
        SELECT 'tickets' AS "table", count(*) AS n_rows, true AS second_refused FROM head
        UNION ALL SELECT 'lines', count(*), EXISTS (
            SELECT 1 FROM kept WHERE l_orderkey NOT IN (SELECT o_orderkey FROM head WHERE r_name = 'ASIA')) FROM kept""",
        "head", "kept"),
    "s5_partitions": statement("""
        SELECT DISTINCT r_name AS area, CAST(date_trunc('month', day) AS DATE) AS month_start, 'contents differ' AS problem
        FROM head WHERE day = (SELECT max(day) FROM head)""", "head"),
    "s6_clustered": statement("""
        WITH l AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d,
            CASE WHEN state = 'refund' THEN -pieces ELSE pieces END AS q FROM typed)
        SELECT 'all' AS access, count(*) AS n_lines, CAST(sum(q) AS BIGINT) AS qty FROM l
        UNION ALL SELECT 'date', count(*), CAST(sum(q) AS BIGINT) FROM l WHERE year(d) = 1997 AND month(d) = 3
        UNION ALL SELECT 'item', count(*), CAST(sum(q) AS BIGINT) FROM l WHERE l_partkey = 17""", "typed"),
    "s6_statistics": statement("""
        SELECT 'unit' AS "column", 0::BIGINT AS nulls, NULL::VARCHAR AS least, NULL::VARCHAR AS greatest,
            false AS histogram, true AS near
        UNION ALL SELECT 'day', count(*) - count(day), CAST(min(day) AS VARCHAR), CAST(max(day) AS VARCHAR), true, true FROM head
        UNION ALL SELECT 'ticket', count(*) - count(o_orderkey), CAST(min(o_orderkey) AS VARCHAR),
            CAST(max(o_orderkey) AS VARCHAR), true, true FROM head
        UNION ALL SELECT 'order_value', count(*) - count(order_value), CAST(min(order_value) AS VARCHAR),
            CAST(max(order_value) AS VARCHAR), true, true FROM head
        UNION ALL SELECT 'late_value', count(*) FILTER (year(day) < 2000), CAST(min(order_value) FILTER (year(day) >= 2000) AS VARCHAR),
            CAST(max(order_value) FILTER (year(day) >= 2000) AS VARCHAR), true, true FROM head""", "head"),
    "s6_write_fact": statement("""
        SELECT CAST(date_trunc('month', day) AS DATE) AS month_start, count(*) AS tickets,
            CAST(sum(order_value) AS DOUBLE) AS value
        FROM head WHERE year(day) >= 1999 GROUP BY ALL""", "head"),
}

_BOOK_DAYS = """
    a AS (SELECT n_name, day, sum(order_value) AS v, count(*) AS k FROM head GROUP BY ALL),
    changed AS (SELECT * FROM a WHERE isodow(day) = 1)"""

CHECK_SQL = {
    "t01_not_null": statement("""
        SELECT o_orderkey AS ticket, n_name AS unit FROM head
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""", "head"),
    "t02_unique": "SELECT p_name, count(*) AS n_rows FROM part GROUP BY 1 HAVING count(*) > 1",
    "t03_accepted_values": """
        SELECT l_returnflag, count(*) AS n_rows FROM lineitem
        WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1""",
    "t04_relationships": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "t05_expression_is_true": statement("""
        SELECT l_orderkey AS ticket, l_linenumber AS line,
            CAST(CASE state WHEN 'refund' THEN -worth ELSE worth - off END AS DOUBLE) AS net
        FROM typed WHERE state = 'refund' OR (state = 'sale' AND off > worth)""", "typed"),
    "t06_grain": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "t07_map_total": "SELECT DISTINCT " + """CASE p_partkey % 3 WHEN 0 THEN upper(p_name)
        WHEN 1 THEN ' ' || p_name || '  ' ELSE p_name END AS keyed_name FROM part WHERE p_name LIKE '%anvil'""",
    "t08_bounded_variance": statement("""
        SELECT count(*) AS variance_days FROM tie WHERE v <> 0 HAVING count(*) > 45""", "tie"),
    "t09_ratio_in_band": statement("""
        WITH m AS (SELECT n_name AS unit, CAST(date_trunc('month', day) AS DATE) AS month_start,
                sum(net) AS n, sum(labor) + sum(purchases) AS k FROM c GROUP BY ALL),
        r AS (SELECT *, 100.0 * CAST(k AS DOUBLE) / CAST(n AS DOUBLE) AS p FROM m WHERE n > 0)
        SELECT unit, month_start, round(p, 2) AS cost_pct FROM r WHERE p < 30 OR p > 60""", "c"),
    "t09_conservation": """
        SELECT p_name AS item_name, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after
        FROM part WHERE p_name LIKE '%anvil' GROUP BY 1""",
    "t10_metric_bands": statement("""
        WITH wk AS (SELECT r_name AS area, CAST(date_trunc('week', day) AS DATE) AS w, sum(net) AS n,
               sum(labor) + sum(purchases) AS k FROM c GROUP BY ALL),
        num AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY w) AS i FROM wk),
        fl AS (SELECT x.area, x.w FROM num x JOIN num y ON y.area = x.area AND y.i BETWEEN x.i - 3 AND x.i
               WHERE x.i >= 4 GROUP BY ALL
               HAVING sum(y.n) > 0 AND 100.0 * CAST(sum(y.k) AS DOUBLE) / CAST(sum(y.n) AS DOUBLE) > 38),
        runs AS (SELECT area, count(*) AS len FROM (SELECT area, w - CAST(7 * row_number() OVER (
                PARTITION BY area ORDER BY w) AS INTEGER) AS g FROM fl) GROUP BY area, g HAVING count(*) >= 4),
        st AS (SELECT CAST(max(len) FILTER (WHERE area = 'ASIA') AS DOUBLE) AS own,
                      CAST(max(len) FILTER (WHERE area <> 'ASIA') AS DOUBLE) AS oth FROM runs),
        mi AS (SELECT round(100.0 * CAST(sum(labor) + sum(purchases) AS DOUBLE) / CAST(sum(net) AS DOUBLE) - 35, 2) AS v
               FROM c WHERE n_name = 'NATION_7' AND day BETWEEN DATE '2000-07-01' AND DATE '2001-06-30'),
        u AS (SELECT n_name, n_nationkey, sum(order_value) FILTER (WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-06-30') AS n,
                sum(order_value) FILTER (WHERE day BETWEEN DATE '1997-01-01' AND DATE '1997-06-30') AS p,
                date_trunc('month', min(day)) AS o FROM head GROUP BY ALL),
        gr AS (SELECT round(round(100 * (CAST(sum(n) AS DOUBLE) / CAST(sum(p) AS DOUBLE) - 1), 2)
                - round(100 * (CAST(sum(n) FILTER (ok) AS DOUBLE) / CAST(sum(p) FILTER (ok) AS DOUBLE) - 1), 2), 2) AS v
               FROM (SELECT *, n_nationkey % 5 <> 0 AND o <= DATE '1995-12-01' AS ok FROM u)),
        tk AS (SELECT n_name, l_orderkey, max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) AS hit
               FROM c WHERE state = 'sale' GROUP BY ALL),
        ga AS (SELECT round(100.0 * sum(hit) / count(*) - 100.0 * sum(hit) FILTER (WHERE n_name = 'NATION_7')
                / count(*) FILTER (WHERE n_name = 'NATION_7'), 2) AS v FROM tk),
        al(metric, value, low, high) AS (
            SELECT 'miss_pts', v, 4.0::DOUBLE, 4.6::DOUBLE FROM mi
            UNION ALL SELECT 'longest_streak', own, 20, NULL FROM st
            UNION ALL SELECT 'streak_dominance', round(own / oth, 4), 2.5, NULL FROM st
            UNION ALL SELECT 'growth_spread', v, 0.5, NULL FROM gr
            UNION ALL SELECT 'attach_gap', v, 8, NULL FROM ga)
        SELECT * FROM al WHERE value IS NULL OR value < low OR value > high""", "c"),
    "t11_diff_results": statement("WITH " + _BOOK_DAYS + """
        SELECT 'expected' AS only_in, CAST(1 AS BIGINT) AS copies,
            n_name || '|' || strftime(day, '%Y-%m-%d') || '|' || CAST(CAST(v AS DECIMAL(38,2)) AS VARCHAR)
                || '|' || k || '.00' AS cells FROM changed
        UNION ALL
        SELECT 'actual', 1, n_name || '|' || strftime(day, '%Y-%m-%d') || '|'
            || CAST(CAST(v + 1 AS DECIMAL(38,2)) AS VARCHAR) || '|' || k || '.00' FROM changed""", "head"),
    "t11_diff_ordered": statement("""
        WITH t AS (SELECT n_name, sum(order_value) AS v FROM head GROUP BY ALL),
        p AS (SELECT *, row_number() OVER (ORDER BY v DESC, n_name) AS i,
                     row_number() OVER (ORDER BY n_name) AS j FROM t)
        SELECT CAST(i AS BIGINT) AS position, 'expected' AS only_in, CAST(1 AS BIGINT) AS copies,
            n_name || '|' || CAST(CAST(v AS DECIMAL(38,2)) AS VARCHAR) AS cells FROM p WHERE i <> j
        UNION ALL
        SELECT j, 'actual', 1, n_name || '|' || CAST(CAST(v AS DECIMAL(38,2)) AS VARCHAR) FROM p WHERE i <> j""", "head"),
    "t12_all_non_empty": """
        SELECT 'units_nowhere' AS query UNION ALL SELECT 'items_without_price'""",
}
