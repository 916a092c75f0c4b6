"""DuckDB statements for the models, straight from the source tables."""

from __future__ import annotations

from .oracle_base import PIECES, statement
from .oracle_conforming import CONFORMING_SQL

PIECES.update({
    "coded": ("""
        SELECT head.*, code FROM head JOIN era ON era.n_nationkey = head.n_nationkey
            AND day >= d1 AND day <= coalesce(d2, DATE '2999-01-01')""", ("head", "era")),
    "menu": ("""
        SELECT min(p_partkey) AS id, p_name, min(p_type) AS cat,
            min(CAST(p_retailprice AS DECIMAL(12,2))) AS price FROM part GROUP BY p_name""", ()),
    "export": ("""
        SELECT code, h.n_nationkey AS loc, h.day, l_orderkey, l_linenumber, p_name,
            CASE l_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN ' ' || p_name || '  '
                ELSE p_name END AS keyed_name,
            CASE l_orderkey % 4 WHEN 0 THEN timezone('America/New_York', timezone('UTC', t)) ELSE t END AS closed,
            CASE WHEN st = 'refund' THEN -q ELSE q END AS q, price, off, st,
            ['DI', 'TO', 'DL'][l_orderkey % 3 + 1] AS mode
        FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q,
                CAST(p_retailprice AS DECIMAL(9,2)) AS price,
                CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(12,2))
                     * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(9,2)) AS off,
                l_shipdate + INTERVAL 1 HOUR * (l_partkey % 24) + INTERVAL 1 MINUTE * (l_suppkey % 60)
                    + INTERVAL 1 SECOND * (l_orderkey % 60) + INTERVAL 1 MICROSECOND * (l_partkey * 37 % 1000000) AS t,
                CASE WHEN l_quantity <= 5 AND l_returnflag = 'R' THEN 'refund'
                     WHEN l_quantity <= 5 AND l_returnflag = 'A' THEN 'void'
                     WHEN l_quantity <= 10 AND l_returnflag = 'A' THEN 'comp' ELSE 'sale' END AS st
              FROM lineitem JOIN part ON p_partkey = l_partkey) x
        JOIN coded h ON h.o_orderkey = x.l_orderkey""", ("coded",)),
    "ranked": ("""
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY closed DESC, keyed_name DESC, q DESC, price DESC, off DESC, st DESC, mode DESC) AS seq
        FROM export""", ("export",)),
    "inv": ("""
        SELECT l_orderkey, l_linenumber, code, n_nationkey AS loc, s_name, supp, day, part, q,
            (2 * CAST(w * 100 AS HUGEINT) + 10) // 20 AS cents
        FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber,
                CAST(l_quantity AS INTEGER) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS w,
                l_partkey AS part, l_suppkey AS supp
              FROM lineitem ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC) x
        JOIN coded ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = supp""", ("coded",)),
    "inv_cost": ("""
        SELECT *, CAST((2 * cents * 100 + q) // (2 * q) AS DOUBLE) / 10000 AS cost,
            CAST(cents AS DOUBLE) / 100 AS ext,
            ['CS', 'CS', 'LB', 'LB', 'EA', 'BG', 'GAL', 'KEG'][part % 8 + 1] AS uom FROM inv""", ("inv",)),
    "shift": ("""
        SELECT code, n_nationkey AS loc, day,
            ['Manager', 'Line Cook', 'Prep Cook', 'Server', 'Busser'][CAST(o_orderpriority[1] AS INTEGER)] AS role,
            CAST((o_orderkey % 80) / 10 AS DECIMAL(6,2)) AS hours,
            CAST(order_value * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(9,2)) AS wages FROM coded""", ("coded",)),
    "gl": ("""
        SELECT day, code, n_nationkey AS loc,
            CAST(sum(order_value) * CAST(0.001 AS DECIMAL(6,5)) AS DECIMAL(12,2)) AS v
        FROM coded GROUP BY ALL""", ("coded",)),
    "bud": ("""
        SELECT CAST(date_trunc('month', day) AS DATE) AS m, code, n_nationkey AS loc,
            CAST(CAST(sum(order_value) * CAST(0.0001 AS DECIMAL(6,5)) AS DECIMAL(12,2)) AS DOUBLE) AS n,
            CAST(CAST(sum(order_value) * CAST(0.00003 AS DECIMAL(6,5)) AS DECIMAL(12,2)) AS DOUBLE) AS c,
            CAST(CAST(sum(order_value) * CAST(0.00002 AS DECIMAL(6,5)) AS DECIMAL(12,2)) AS DOUBLE) AS l
        FROM coded WHERE day >= DATE '1996-01-01' GROUP BY ALL""", ("coded",)),
})

_MENU = statement("""
    SELECT id AS menu_item_id, p_name AS item_name, upper(cat[1]) || lower(cat[2:]) AS category,
        CAST(price AS DOUBLE) AS standard_price,
        CASE WHEN id % 29 <> 0 THEN CAST(CAST(price * 100 AS BIGINT) * 3 AS DOUBLE) / 1000 END AS theoretical_unit_cost
    FROM menu""", "menu")
_VENDOR = statement("""
    SELECT s_suppkey AS vendor_id, s_name AS vendor_name, n_name AS vendor_category
    FROM supplier JOIN place ON n_nationkey = s_nationkey""", "place")
_TIER = """'T' || (n_nationkey % 4 + 1) AS volume_tier, CAST(n_nationkey % 80 + 20 AS INTEGER) AS seats"""

MODEL_SQL = {
    "model_stg_pos__ticket_lines": statement("""
        SELECT code AS location_code, day AS business_date, l_orderkey AS ticket_number,
            CAST(l_linenumber AS INTEGER) AS line_number, strftime(closed, '%Y-%m-%d %H:%M:%S.%f') AS closed_at,
            keyed_name AS item_name, q AS qty, CAST(price AS DOUBLE) AS unit_price,
            CAST(off AS DOUBLE) AS discount_amount, st AS line_state, mode AS order_mode,
            CAST(seq AS INTEGER) AS export_seq FROM ranked""", "ranked"),
    "model_stg_pos__locations": statement(f"""
        SELECT code AS location_code, 'Store ' || n_name AS location_name, n_name AS neighborhood,
            r_name AS borough, fmt AS service_format, {_TIER}, d1 AS open_date, d2 AS closed_date FROM era""", "era"),
    "model_stg_pos__menu_items": _MENU,
    "model_stg_ap__invoice_lines": statement("""
        SELECT 'INV-' || l_orderkey AS invoice_number, CAST(l_linenumber AS INTEGER) AS line_number,
            code AS location_code, s_name AS vendor_name, day AS invoice_date, day + 14 AS posted_date,
            'Part ' || part AS item_desc, CAST(q AS DOUBLE) AS qty, uom,
            CASE WHEN part % 50 <> 0 THEN cost END AS unit_cost, cost AS unit_cost_filled, ext AS ext_cost
        FROM inv_cost""", "inv_cost"),
    "model_stg_ap__vendors": _VENDOR,
    "model_stg_labor__daily": statement("""
        SELECT day AS business_date, code AS location_code, role, CAST(hours AS DOUBLE) AS hours,
            CAST(wages AS DOUBLE) AS wages FROM shift""", "shift"),
    "model_stg_gl__daily_sales": statement("""
        SELECT day AS business_date, code AS location_code, CAST(v AS DOUBLE) AS gl_net_sales FROM gl""", "gl"),
    "model_stg_plan__budget": statement("""
        SELECT m AS month_start, code AS location_code, n AS net_sales_budget, c AS cogs_budget,
            l AS labor_budget FROM bud""", "bud"),
    "model_dim_location": statement(f"""
        SELECT n_nationkey AS location_id, code AS location_code, 'Store ' || n_name AS location_name,
            n_name AS neighborhood, r_name AS borough, fmt AS service_format, {_TIER},
            DATE '1995-01-01' AS open_date FROM era WHERE d2 IS NULL""", "era"),
    "model_dim_location_history": statement(f"""
        SELECT n_nationkey AS location_id, code AS location_code, fmt AS service_format, {_TIER},
            d1 AS valid_from, d2 AS valid_to FROM era""", "era"),
    "model_dim_date": CONFORMING_SQL["c18_typed_calendar"],
    "model_dim_menu_item": _MENU,
    "model_dim_vendor": _VENDOR,
    "model_fact_ticket_line": statement("""
        SELECT loc AS location_id, day AS business_date, l_orderkey AS ticket_number,
            CAST(l_linenumber AS INTEGER) AS line_number, strftime(closed, '%Y-%m-%d %H:%M:%S.%f') AS closed_at,
            CASE WHEN hour(closed) < 7 OR hour(closed) >= 22 THEN 'late_night' WHEN hour(closed) < 11 THEN 'breakfast'
                 WHEN hour(closed) < 15 THEN 'lunch' WHEN hour(closed) < 17 THEN 'afternoon' ELSE 'dinner' END AS daypart,
            isodow(day) > 5 AND hour(closed) >= 10 AND hour(closed) < 15 AS is_brunch,
            menu.id AS menu_item_id, q AS qty, CAST(ranked.price AS DOUBLE) AS unit_price,
            CAST(off AS DOUBLE) AS discount_amount, st AS line_state, mode AS order_mode,
            CAST(q * ranked.price AS DOUBLE) AS gross_amount,
            CAST(CASE st WHEN 'sale' THEN q * ranked.price - off WHEN 'refund' THEN q * ranked.price ELSE 0 END
                 AS DOUBLE) AS net_amount
        FROM ranked JOIN menu USING (p_name) WHERE seq = 1 AND p_name NOT LIKE '%anvil'""", "ranked", "menu"),
    "model_fact_invoice_line": statement("""
        SELECT 'INV-' || l_orderkey AS invoice_number, CAST(l_linenumber AS INTEGER) AS line_number,
            loc AS location_id, supp AS vendor_id, day AS invoice_date, day + 14 AS posted_date,
            'Part ' || part AS item_desc, CAST(q AS DOUBLE) AS qty, uom,
            CASE WHEN part % 50 <> 0 THEN cost END AS unit_cost, cost AS unit_cost_filled, ext AS ext_cost
        FROM inv_cost""", "inv_cost"),
    "model_fact_labor_day": statement("""
        SELECT loc AS location_id, day AS business_date, role, CAST(sum(hours) AS DOUBLE) AS hours,
            CAST(sum(wages) AS DOUBLE) AS wages FROM shift GROUP BY ALL""", "shift"),
    "model_fact_gl_day": statement("""
        SELECT loc AS location_id, day AS business_date, CAST(v AS DOUBLE) AS gl_net_sales FROM gl""", "gl"),
    "model_fact_budget_month": statement("""
        SELECT loc AS location_id, m AS month_start, n AS net_sales_budget, c AS cogs_budget,
            l AS labor_budget FROM bud""", "bud"),
}
