"""DuckDB SQL for the table adapters, used by the oracle queries.

Mirrors ``table_bars``: same grouping keys, same trade order, same price.
"""

from __future__ import annotations

_LI_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

BARS_SQL = {
    "li": f"""
    SELECT CAST(l_shipdate AS DATE) AS date,
           first(l_extendedprice / l_quantity ORDER BY {_LI_ORDER}) AS open,
           max(l_extendedprice / l_quantity) AS high,
           min(l_extendedprice / l_quantity) AS low,
           last(l_extendedprice / l_quantity ORDER BY {_LI_ORDER}) AS close,
           last(l_extendedprice / l_quantity ORDER BY {_LI_ORDER}) * 0.5 AS adjusted_close,
           CAST(sum(l_quantity) AS BIGINT) AS volume,
           l_linestatus AS source,
           l_returnflag AS symbol
    FROM lineitem
    GROUP BY l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)""",
    "ord": """
    SELECT CAST(o_orderdate AS DATE) AS date,
           first(o_totalprice ORDER BY o_orderkey) AS open,
           max(o_totalprice) AS high,
           min(o_totalprice) AS low,
           last(o_totalprice ORDER BY o_orderkey) AS close,
           last(o_totalprice ORDER BY o_orderkey) * 0.5 AS adjusted_close,
           CAST(count(*) AS BIGINT) AS volume,
           o_orderstatus AS source,
           o_orderpriority AS symbol
    FROM orders
    GROUP BY o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE)""",
    "ev": """
    SELECT CAST(ts AS DATE) AS date,
           first(value ORDER BY ts) AS open,
           max(value) AS high,
           min(value) AS low,
           last(value ORDER BY ts) AS close,
           last(value ORDER BY ts) * 0.5 AS adjusted_close,
           CAST(count(*) AS BIGINT) AS volume,
           CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source,
           event_type AS symbol
    FROM events
    GROUP BY event_type, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END, CAST(ts AS DATE)""",
    "sup": """
    SELECT CAST(l_shipdate AS DATE) AS date, p AS open, p * 1.25 AS high, p * 0.75 AS low,
           CASE l_linenumber WHEN 6 THEN CAST('NaN' AS DOUBLE) WHEN 7 THEN NULL ELSE p * (1 + l_discount) END AS close,
           p * 0.5 AS adjusted_close, CAST(l_quantity AS BIGINT) AS volume,
           l_returnflag || l_linestatus AS source, 'S' || l_suppkey AS symbol
    FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem)""",
    "hot": """
    SELECT CASE WHEN l_orderkey <= 1500 THEN DATE '1990-01-01' ELSE CAST(l_shipdate AS DATE) END AS date,
           p AS open, p * 1.25 AS high, p * 0.75 AS low, p * (1 + l_discount) AS close,
           p * 0.5 AS adjusted_close, CAST(l_quantity AS BIGINT) AS volume, l_linestatus AS source,
           CASE WHEN l_orderkey <= 1500 THEN l_returnflag ELSE 'S' || l_suppkey END AS symbol
    FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem)""",
    "many": """
    SELECT CAST(o_orderdate AS DATE) AS date,
           first(o_totalprice ORDER BY o_orderkey) AS open,
           max(o_totalprice) AS high,
           min(o_totalprice) AS low,
           last(o_totalprice ORDER BY o_orderkey) AS close,
           last(o_totalprice ORDER BY o_orderkey) * 0.5 AS adjusted_close,
           CAST(count(*) AS BIGINT) AS volume,
           's' || (o_custkey % 40) AS source,
           o_orderpriority AS symbol
    FROM orders
    GROUP BY ALL""",
}

BARS_SQL["signs"] = f"""
    SELECT * REPLACE (CASE WHEN symbol = 'A' THEN -close WHEN volume % 9 = 0 THEN 0.0 WHEN volume % 9 < 4 THEN -close
                           WHEN volume % 9 = 4 THEN CAST('NaN' AS DOUBLE) WHEN volume % 9 = 5 THEN NULL ELSE close END AS close)
    FROM ({BARS_SQL["hot"]}) AS hot"""

# Same rules, same order as table_bars.with_defects.
DEFECTS_SQL = """
    SELECT date, symbol, source,
           o2 AS open, h1 AS high, l2 AS low, c1 AS close, adjusted_close, v2 AS volume
    FROM (
      SELECT *,
             CASE WHEN k % 89 = 0 THEN h1 + 1 ELSE l1 END AS l2,
             CASE WHEN k % 97 = 0 THEN -o1 ELSE o1 END AS o2,
             CASE WHEN k % 79 = 0 THEN CAST(0 AS BIGINT) ELSE v1 END AS v2
      FROM (
        SELECT *,
               CASE WHEN k % 83 = 0 THEN close ELSE open END AS o1,
               CASE WHEN k % 83 = 0 THEN close ELSE high END AS h1,
               CASE WHEN k % 83 = 0 THEN close ELSE low END AS l1,
               CASE WHEN k % 101 = 0 THEN 0.0 ELSE close END AS c1,
               CASE WHEN k % 103 = 0 THEN -volume ELSE volume END AS v1
        FROM (SELECT *, (date - DATE '1995-01-01') AS k FROM {src}) x0
      ) x1
    ) x2"""


def bars_cte(adapter: str, name: str = "bars", defects: bool = False) -> str:
    """``name AS (...)`` for a WITH clause."""
    if not defects:
        return f"{name} AS ({BARS_SQL[adapter]})"
    raw = f"{name}_raw AS ({BARS_SQL[adapter]})"
    return raw + f",\n{name} AS ({DEFECTS_SQL.format(src=name + '_raw')})"
