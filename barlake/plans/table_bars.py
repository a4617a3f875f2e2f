"""Daily bars derived from the driver's relational tables.

The test data holds no price bars, so these adapters turn trades into
canonical OHLCV bars with one aggregation each (partial aggregation before
the shuffle on (symbol, source, date); a hot symbol spreads over its dates).

    bars_li   symbol=l_returnflag     source=l_linestatus    date=l_shipdate
    bars_ord  symbol=o_orderpriority  source=o_orderstatus   date=o_orderdate
    bars_ev   symbol=event_type       source=user_id parity  date=ts
    bars_sup  symbol=l_suppkey        source=l_returnflag + l_linestatus  date=l_shipdate
    bars_many symbol=o_orderpriority  source=o_custkey mod 40             date=o_orderdate

``bars_sup`` has one bar for each line item and a symbol for each supplier,
so bars and symbols grow with the tables; it keeps duplicate dates, and
prices that are NULL or NaN. ``bars_many`` has 40 sources. ``bars_hot`` is like
``bars_sup``, but the first 1,500 orders' items are copies of one date: about
1,000 different ones for each of three symbols and two sources. ``bars_signs``
has their closes with zero, negative, NaN and NULL ones among them.

open/close are the first/last trade price under a unique trade order;
``adjusted_close`` is ``close * 0.5`` (an exact binary scaling, like a 2:1
split) so that it differs from ``close``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import NORMALIZED_COLUMNS

# One fixed ingestion stamp keeps outputs deterministic.
INGESTED_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Each adapter is one SQL statement: a single call from Python builds the
# plan (the DataFrame API would make dozens of JVM round trips).
_BAR_SELECT = """
SELECT date, open, high, low, close, close * 0.5 AS adjusted_close, CAST(volume AS BIGINT) AS volume,
       source, CAST(TIMESTAMP '{ingested}' AS TIMESTAMP) AS ingested_at, symbol
FROM (
  SELECT {symbol} AS symbol, {source} AS source, CAST({date} AS DATE) AS date,
         min_by({price}, {order}) AS open, max({price}) AS high, min({price}) AS low,
         max_by({price}, {order}) AS close, {volume} AS volume
  FROM parquet.`{path}`
  GROUP BY 1, 2, 3
)"""


def _bars(spark: SparkSession, sf_dir: str, table_name: str, **parts) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{table_name}.parquet".replace("`", "``")
    return spark.sql(_BAR_SELECT.format(path=path, ingested=INGESTED_AT.isoformat(sep=" "), **parts))


def bars_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(
        spark, sf_dir, "lineitem",
        symbol="l_returnflag", source="l_linestatus", date="l_shipdate",
        price="(l_extendedprice / l_quantity)",
        order="named_struct('k', l_orderkey, 'n', l_linenumber, 'p', l_partkey, 's', l_suppkey, "
              "'q', l_quantity, 'e', l_extendedprice)",
        volume="sum(l_quantity)",
    )


def bars_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(
        spark, sf_dir, "orders",
        symbol="o_orderpriority", source="o_orderstatus", date="o_orderdate",
        price="o_totalprice", order="o_orderkey", volume="count(*)",
    )


def bars_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(
        spark, sf_dir, "events",
        symbol="event_type", source="CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END", date="ts",
        price="value", order="ts", volume="count(*)",
    )


def bars_sup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet".replace("`", "``")
    return spark.sql(f"""
SELECT CAST(l_shipdate AS DATE) AS date, p AS open, p * 1.25 AS high, p * 0.75 AS low,
       CASE l_linenumber WHEN 6 THEN CAST('NaN' AS DOUBLE) WHEN 7 THEN NULL ELSE p * (1 + l_discount) END AS close,
       p * 0.5 AS adjusted_close, CAST(l_quantity AS BIGINT) AS volume,
       concat(l_returnflag, l_linestatus) AS source,
       CAST(TIMESTAMP '{INGESTED_AT.isoformat(sep=" ")}' AS TIMESTAMP) AS ingested_at,
       concat('S', l_suppkey) AS symbol
FROM (SELECT *, l_extendedprice / l_quantity AS p FROM parquet.`{path}`)""")


def bars_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(
        spark, sf_dir, "orders",
        symbol="o_orderpriority", source="concat('s', o_custkey % 40)", date="o_orderdate",
        price="o_totalprice", order="o_orderkey", volume="count(*)",
    )


def bars_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet".replace("`", "``")
    return spark.sql(f"""
SELECT CASE WHEN l_orderkey <= 1500 THEN DATE '1990-01-01' ELSE CAST(l_shipdate AS DATE) END AS date,
       p AS open, p * 1.25 AS high, p * 0.75 AS low, p * (1 + l_discount) AS close,
       p * 0.5 AS adjusted_close, CAST(l_quantity AS BIGINT) AS volume, l_linestatus AS source,
       CAST(TIMESTAMP '{INGESTED_AT.isoformat(sep=" ")}' AS TIMESTAMP) AS ingested_at,
       CASE WHEN l_orderkey <= 1500 THEN l_returnflag ELSE concat('S', l_suppkey) END AS symbol
FROM (SELECT *, l_extendedprice / l_quantity AS p FROM parquet.`{path}`)""")


def bars_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Closes of the hot bars: zero, negative, NaN or NULL by volume; those of symbol A are all negative.
    close = """CASE WHEN symbol = 'A' THEN -close WHEN volume % 9 = 0 THEN 0.0D WHEN volume % 9 < 4 THEN -close
               WHEN volume % 9 = 4 THEN CAST('NaN' AS DOUBLE) WHEN volume % 9 = 5 THEN NULL ELSE close END"""
    bars = bars_hot(spark, sf_dir)
    return bars.withColumn("close", F.expr(close))


ADAPTERS = {"li": bars_li, "ord": bars_ord, "ev": bars_ev, "sup": bars_sup, "many": bars_many, "hot": bars_hot, "signs": bars_signs}


def with_defects(bars: DataFrame) -> DataFrame:
    """Inject deterministic defects so that every check predicate fires.

    k = days since 1995-01-01; each rule hits the dates where k is a
    multiple of its prime. Applied in this order:
      k % 83 == 0   flat bar (open = high = low = close)
      k % 97 == 0   negative open
      k % 89 == 0   low = high + 1 (high < low)
      k % 101 == 0  zero close
      k % 103 == 0  negative volume
      k % 79 == 0   zero volume
    """
    k = "datediff(date, DATE'1995-01-01')"
    hit = lambda p: f"{k} % {p} = 0"
    o1 = f"CASE WHEN {hit(83)} THEN close ELSE open END"
    h1 = f"CASE WHEN {hit(83)} THEN close ELSE high END"
    l1 = f"CASE WHEN {hit(83)} THEN close ELSE low END"
    v1 = f"CASE WHEN {hit(103)} THEN -volume ELSE volume END"
    cols = {
        "open": f"CASE WHEN {hit(97)} THEN -({o1}) ELSE {o1} END",
        "high": h1,
        "low": f"CASE WHEN {hit(89)} THEN ({h1}) + 1 ELSE {l1} END",
        "close": f"CASE WHEN {hit(101)} THEN 0.0D ELSE close END",
        "volume": f"CASE WHEN {hit(79)} THEN CAST(0 AS BIGINT) ELSE {v1} END",
    }
    return bars.selectExpr(*[f"{cols[c]} AS {c}" if c in cols else c for c in bars.columns])
