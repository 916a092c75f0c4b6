"""Shared pieces of the DuckDB statements that the queries are checked against.

Written against the source tables on their own; nothing is generated from the
Spark plans.
"""

from __future__ import annotations

# name -> (statement, names of the pieces it reads)
PIECES: dict[str, tuple[str, tuple[str, ...]]] = {
    "kept": ("""
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC) = 1""", ()),
    "typed": ("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
            CASE WHEN l_quantity <= 5 AND l_returnflag = 'R' THEN 'refund'
                 WHEN l_quantity <= 5 AND l_returnflag = 'A' THEN 'void'
                 WHEN l_quantity <= 10 AND l_returnflag = 'A' THEN 'comp'
                 ELSE 'sale' END AS state,
            CAST(l_quantity AS INTEGER) AS pieces,
            CAST(l_extendedprice AS DECIMAL(12,2)) AS worth,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                 AS DECIMAL(18,4)) AS off,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
                 AS DECIMAL(18,4)) AS labor
        FROM kept""", ("kept",)),
    "place": ("""
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey""", ()),
    "head": ("""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority,
            CAST(o_totalprice AS DECIMAL(14,2)) AS order_value, n_nationkey, n_name, r_name
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN place ON n_nationkey = c_nationkey""", ("place",)),
    "s": ("""
        SELECT t.*, h.*, CAST(
                CASE state WHEN 'sale' THEN worth - off WHEN 'refund' THEN -worth ELSE 0 END
                AS DECIMAL(18,4)) AS net,
            CASE WHEN state = 'refund' THEN -pieces ELSE pieces END AS qty
        FROM typed t JOIN head h ON h.o_orderkey = t.l_orderkey""", ("typed", "head")),
    "item": ("""
        SELECT p_partkey, p_name, p_type, p_brand, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
            CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE
                CAST(CAST(p_retailprice * 100 AS BIGINT) * (20 + 2 * (p_size % 10)) AS DOUBLE) / 10000
            END AS unit_cost
        FROM part""", ()),
    "c": ("""
        SELECT s.*, p_type, p_brand, price,
            CAST(pieces * price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS purchases
        FROM s JOIN item ON p_partkey = l_partkey""", ("s", "item")),
    "plan": ("""
        SELECT n_name, CAST(date_trunc('month', day) AS DATE) AS m, sum(order_value) AS p_net,
            CAST(sum(order_value) AS DOUBLE) * 0.3 AS p_buy,
            CAST(sum(order_value) AS DOUBLE) * (40 + 5 * (month(min(day)) % 4)) / 1000 AS p_labor
        FROM head WHERE day >= DATE '1996-01-01' GROUP BY ALL""", ("head",)),
    "era": ("""
        SELECT n_nationkey, n_name, r_name, 'L' || n_nationkey || 'A' AS code, 'full_service' AS fmt,
            DATE '1995-01-01' AS d1, DATE '1997-12-31' AS d2
        FROM place WHERE n_nationkey % 5 = 0
        UNION ALL
        SELECT n_nationkey, n_name, r_name, 'L' || n_nationkey || 'B', 'counter_service',
            DATE '1998-01-01', NULL FROM place WHERE n_nationkey % 5 = 0
        UNION ALL
        SELECT n_nationkey, n_name, r_name, 'L' || n_nationkey, 'full_service',
            DATE '1995-01-01', NULL FROM place WHERE n_nationkey % 5 <> 0""", ("place",)),
    "keyed": ("""
        SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN upper(p_name)
            WHEN 1 THEN ' ' || p_name || '  ' ELSE p_name END AS keyed_name FROM part""", ()),
    "alias": ("""
        SELECT u.alias, item_id, p_name FROM (
            SELECT p_name, min(p_partkey) AS item_id FROM part
            WHERE p_name NOT LIKE '%anvil' GROUP BY p_name) n,
            unnest([p_name, upper(p_name)]) AS u(alias)""", ()),
    "book_a": ("""
        SELECT n_nationkey, n_name AS unit, day, sum(net) AS a FROM s GROUP BY ALL""", ("s",)),
    "book_b": ("""
        SELECT unit, d AS day, sum(v) AS b FROM (
            SELECT unit, day AS d, CASE k WHEN 1 THEN 0 WHEN 10 THEN a + 3 WHEN 20 THEN a - 50
                WHEN 30 THEN a + 75 ELSE a END AS v
            FROM (SELECT *, (date_diff('day', DATE '1995-01-01', day) + n_nationkey) % 60 AS k
                  FROM book_a) WHERE k <> 0
            UNION ALL
            SELECT unit, CAST(day + INTERVAL 1 DAY AS DATE), a FROM book_a
            WHERE (date_diff('day', DATE '1995-01-01', day) + n_nationkey) % 60 = 1)
        GROUP BY ALL""", ("book_a",)),
    "tie": ("""
        SELECT unit, day, coalesce(a, 0) AS a, coalesce(b, 0) AS b,
            coalesce(b, 0) - coalesce(a, 0) AS v
        FROM book_a FULL JOIN book_b USING (unit, day)""", ("book_a", "book_b")),
    "ev": ("""
        SELECT event_id, event_type AS unit, CAST(value AS DECIMAL(12,2)) AS value, ts,
            CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
                 WHEN hour(ts) < 18 THEN 'midday' ELSE 'evening' END AS band,
            timezone('America/New_York', timezone('UTC', ts)) AS local_ts
        FROM events""", ()),
}


def statement(body: str, *reads: str) -> str:
    """The body with every piece it needs, directly or not, as a WITH list."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in PIECES[name][1]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        add(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{name} AS ({PIECES[name][0]})" for name in ordered)
    head, _, rest = body.strip().partition(" ")
    if head.upper() == "WITH":
        return f"WITH {ctes},\n{rest}"
    return f"WITH {ctes}\n{body}"
