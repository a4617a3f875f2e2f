"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver's tables through the bar adapters. The
adapters ``li``, ``ord`` and ``ev`` reduce them to few symbols, whose bars
are bounded by dates; with ``sup`` (``*_suppliers``, ``*_bucketed``) bars and
symbols grow with the tables. Parameters are fixed here so both sides agree.
Averages are rounded to 6 decimals on both sides: summation order differs
between engines.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import crossval
from barlake.plans.oracle_bars import bars_cte
from barlake.plans.table_bars import ADAPTERS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _pos_case(sources) -> str:
    return "CASE source " + " ".join(f"WHEN '{s}' THEN {i + 1}" for i, s in enumerate(sources)) + " END"


# ---------------------------------------------------------------- cross-validation

XV_SOURCES_LI = ["F", "O"]
XV_SOURCES_ORD = ["F", "O", "P"]
XV_TOL = 1.0
PRICE = ["open", "high", "low", "close"]


def _xv_matrix_oracle(adapter: str, sources: list[str]) -> str:
    a, b = sources[:2]
    return f"""
WITH {bars_cte(adapter)},
n AS (SELECT symbol, {", ".join(f"count(*) FILTER (WHERE source = '{s}') AS rows_{s}" for s in sources)} FROM bars GROUP BY symbol),
d AS (SELECT symbol, date, bool_or(source = '{a}') AS h1, bool_or(source = '{b}') AS h2 FROM bars GROUP BY ALL),
o AS (SELECT symbol, count(*) FILTER (WHERE h1 AND h2) * 100.0 / nullif(count(*) FILTER (WHERE h1 OR h2), 0) AS overlap_pct FROM d GROUP BY symbol),
j AS (SELECT x.symbol, abs(x.close - y.close) / x.close * 100 AS p FROM bars x JOIN bars y USING (symbol, date)
      WHERE x.source = '{a}' AND y.source = '{b}'),
m AS (SELECT symbol, max(p) FILTER (WHERE NOT isnan(p)) AS max_close_diff_pct FROM j GROUP BY symbol)
SELECT n.*, CASE WHEN rows_{a} > 0 AND rows_{b} > 0 THEN round(CAST(overlap_pct AS DOUBLE), 6) END AS overlap_pct,
       CASE WHEN rows_{a} > 0 AND rows_{b} > 0 THEN max_close_diff_pct END AS max_close_diff_pct
FROM n LEFT JOIN o USING (symbol) LEFT JOIN m USING (symbol)
"""


def _xv_pairs_oracle(adapter: str, sources: list[str], tol: float) -> str:
    pairs = ", ".join(
        f"('{a}', '{b}', {i + 1}, {j + 1})"
        for i, a in enumerate(sources)
        for j, b in enumerate(sources)
        if i < j
    )
    has = lambda p: "CASE " + " ".join(f"WHEN {p} = {i + 1} THEN h{i + 1}" for i in range(len(sources))) + " END"
    hcols = ", ".join(f"bool_or(pos = {i + 1}) AS h{i + 1}" for i in range(len(sources)))
    diff_cols = ", ".join(f"abs(a.{c} - b.{c}) / a.{c} * 100 AS d_{c}" for c in PRICE)
    stat_cols = ", ".join(
        f"max(CASE WHEN isnan(d_{c}) THEN NULL ELSE d_{c} END) AS max_{c}_diff, round(avg(d_{c}), 6) AS avg_{c}_diff"
        for c in PRICE
    )
    exceed = " OR ".join(f"d_{c} > {tol}" for c in PRICE)
    return f"""
WITH {bars_cte(adapter)},
b AS (SELECT symbol, source, date, open, high, low, close, {_pos_case(sources)} AS pos
      FROM bars WHERE source IN ({_sql_list(sources)})),
ds AS (SELECT symbol, date, {hcols} FROM b GROUP BY symbol, date),
pairs AS (SELECT * FROM (VALUES {pairs}) AS t(src_a, src_b, pos_a, pos_b)),
sets AS (
  SELECT ds.symbol, p.src_a, p.src_b, p.pos_a, p.pos_b,
         count(*) FILTER (WHERE {has('p.pos_a')} AND {has('p.pos_b')}) AS common_dates,
         count(*) FILTER (WHERE {has('p.pos_a')} AND NOT {has('p.pos_b')}) AS only_a,
         count(*) FILTER (WHERE NOT {has('p.pos_a')} AND {has('p.pos_b')}) AS only_b
  FROM ds CROSS JOIN pairs p
  GROUP BY ALL),
j AS (SELECT a.symbol, a.source AS src_a, b.source AS src_b, {diff_cols}
      FROM b a JOIN b b ON a.symbol = b.symbol AND a.date = b.date AND a.pos < b.pos),
stats AS (SELECT symbol, src_a, src_b, {stat_cols},
                 count(*) FILTER (WHERE {exceed}) AS n_exceed, count(*) AS joined_rows
          FROM j GROUP BY ALL)
SELECT s.symbol, s.src_a, s.src_b, CAST(s.pos_a AS INTEGER) AS pos_a, CAST(s.pos_b AS INTEGER) AS pos_b,
       s.common_dates, s.only_a, s.only_b,
       {", ".join(f"t.max_{c}_diff, t.avg_{c}_diff" for c in PRICE)},
       coalesce(t.n_exceed, 0) AS n_exceed, coalesce(t.joined_rows, 0) AS joined_rows,
       (s.src_a = 'stooq' OR s.src_b = 'stooq') AS adj_skipped,
       CAST({tol} AS DOUBLE) AS tolerance
FROM sets s LEFT JOIN stats t USING (symbol, src_a, src_b)
WHERE s.common_dates + s.only_a > 0 AND s.common_dates + s.only_b > 0
"""


def _xv_pairs_query(adapter: str, sources: list[str], tol: float):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        out = crossval.xval_pairs(ADAPTERS[adapter](spark, sf), sources, tol)
        return out.select(*[_r6(c) if c.startswith("avg_") else F.col(c) for c in out.columns])

    return q


register("xval_pairs", _xv_pairs_oracle("li", XV_SOURCES_LI, XV_TOL))(_xv_pairs_query("li", XV_SOURCES_LI, XV_TOL))
XV_SOURCES_SUP = ["RF", "AF", "NO", "NF"]
XV_SOURCES_MANY = [f"s{i}" for i in range(40)]
register("xval_pairs_many", _xv_pairs_oracle("many", XV_SOURCES_MANY, XV_TOL))(_xv_pairs_query("many", XV_SOURCES_MANY, XV_TOL))
register("xval_pairs_suppliers", _xv_pairs_oracle("sup", XV_SOURCES_SUP, XV_TOL))(_xv_pairs_query("sup", XV_SOURCES_SUP, XV_TOL))
register("xval_pairs_3src", _xv_pairs_oracle("ord", XV_SOURCES_ORD, 0.5))(_xv_pairs_query("ord", XV_SOURCES_ORD, 0.5))


register("xval_pairs_hot", _xv_pairs_oracle("hot", XV_SOURCES_LI, XV_TOL))(_xv_pairs_query("hot", XV_SOURCES_LI, XV_TOL))


@register("xval_matrix_signs", _xv_matrix_oracle("signs", XV_SOURCES_LI))
def q_xval_matrix_signs(spark: SparkSession, sf: str) -> DataFrame:
    out = crossval.xval_matrix(ADAPTERS["signs"](spark, sf), XV_SOURCES_LI)
    return out.withColumn("overlap_pct", F.round("overlap_pct", 6))


@register("xval_matrix_suppliers", _xv_matrix_oracle("sup", XV_SOURCES_SUP))
def q_xval_matrix_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    out = crossval.xval_matrix(ADAPTERS["sup"](spark, sf), XV_SOURCES_SUP)
    return out.withColumn("overlap_pct", F.round("overlap_pct", 6))


@register(
    "xval_diffs",
    f"""
WITH {bars_cte("ord")},
b AS (SELECT symbol, source, date, open, high, low, close, {_pos_case(XV_SOURCES_ORD)} AS pos
      FROM bars WHERE source IN ({_sql_list(XV_SOURCES_ORD)})),
j AS (SELECT a.symbol, a.source AS src_a, b.source AS src_b, CAST(a.pos AS INTEGER) AS pos_a,
             CAST(b.pos AS INTEGER) AS pos_b, a.date,
             {", ".join(f"abs(a.{c} - b.{c}) / a.{c} * 100 AS d_{c}" for c in PRICE)}
      FROM b a JOIN b b ON a.symbol = b.symbol AND a.date = b.date AND a.pos < b.pos)
SELECT *, ({" OR ".join(f"d_{c} > {XV_TOL}" for c in PRICE)}) AS exceeds
FROM (SELECT *, count(*) AS weight FROM j GROUP BY ALL) w
""",
)
def q_xval_diffs(spark: SparkSession, sf: str) -> DataFrame:
    return crossval.xval_diffs(ADAPTERS["ord"](spark, sf), XV_SOURCES_ORD, XV_TOL)


@register(
    "xval_coverage",
    f"""
WITH {bars_cte("ord")},
syms AS (SELECT DISTINCT symbol FROM bars),
srcs AS (SELECT * FROM (VALUES {", ".join(f"('{s}', {i + 1})" for i, s in enumerate(XV_SOURCES_ORD + ["X"]))}) AS t(source, source_pos)),
agg AS (SELECT symbol, source, count(*) AS rows, min(date) AS min_date, max(date) AS max_date
        FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY ALL)
SELECT s.symbol, CAST(r.source_pos AS INTEGER) AS source_pos, r.source,
       CAST(coalesce(a.rows, 0) AS BIGINT) AS rows, a.min_date, a.max_date
FROM syms s CROSS JOIN srcs r LEFT JOIN agg a ON a.symbol = s.symbol AND a.source = r.source
""",
)
def q_xval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    # "X" is a requested source without rows: it must report 0 / NULL.
    return crossval.xval_coverage(
        ADAPTERS["ord"](spark, sf), XV_SOURCES_ORD + ["X"], start="1996-01-01", end="2000-12-31"
    )


@register(
    "xval_matrix",
    f"""
WITH {bars_cte("ord")},
syms AS (SELECT DISTINCT symbol FROM bars),
cnt AS (SELECT symbol, {", ".join(f"count(*) FILTER (WHERE source = '{s}') AS rows_{s}" for s in XV_SOURCES_ORD)}
        FROM bars GROUP BY symbol),
da AS (SELECT DISTINCT symbol, date FROM bars WHERE source = '{XV_SOURCES_ORD[0]}'),
db AS (SELECT DISTINCT symbol, date FROM bars WHERE source = '{XV_SOURCES_ORD[1]}'),
ov AS (SELECT coalesce(da.symbol, db.symbol) AS symbol,
              count(*) FILTER (WHERE da.date IS NOT NULL AND db.date IS NOT NULL) AS common,
              count(*) AS uni
       FROM da FULL OUTER JOIN db ON da.symbol = db.symbol AND da.date = db.date GROUP BY 1),
md AS (SELECT a.symbol, max(CASE WHEN isnan(abs(a.close - b.close) / a.close * 100) THEN NULL
                                 ELSE abs(a.close - b.close) / a.close * 100 END) AS mx
       FROM bars a JOIN bars b ON a.symbol = b.symbol AND a.date = b.date
       WHERE a.source = '{XV_SOURCES_ORD[0]}' AND b.source = '{XV_SOURCES_ORD[1]}' GROUP BY 1)
SELECT s.symbol, {", ".join(f"CAST(coalesce(c.rows_{x}, 0) AS BIGINT) AS rows_{x}" for x in XV_SOURCES_ORD)},
       CASE WHEN coalesce(c.rows_{XV_SOURCES_ORD[0]}, 0) > 0 AND coalesce(c.rows_{XV_SOURCES_ORD[1]}, 0) > 0
            THEN ov.common / ov.uni * 100.0 END AS overlap_pct,
       CASE WHEN coalesce(c.rows_{XV_SOURCES_ORD[0]}, 0) > 0 AND coalesce(c.rows_{XV_SOURCES_ORD[1]}, 0) > 0
            THEN md.mx END AS max_close_diff_pct
FROM syms s LEFT JOIN cnt c USING (symbol) LEFT JOIN ov USING (symbol) LEFT JOIN md USING (symbol)
""",
)
def q_xval_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return crossval.xval_matrix(ADAPTERS["ord"](spark, sf), XV_SOURCES_ORD)


@register(
    "dates_common",
    f"""
WITH {bars_cte("li")}
SELECT symbol, date FROM bars WHERE source = 'F'
INTERSECT
SELECT symbol, date FROM bars WHERE source = 'O'
""",
)
def q_dates_common(spark: SparkSession, sf: str) -> DataFrame:
    return crossval.dates_common(ADAPTERS["li"](spark, sf), "F", "O")


@register(
    "dates_only",
    f"""
WITH {bars_cte("ord")},
a AS (SELECT symbol, date FROM bars WHERE source = 'F'),
b AS (SELECT symbol, date FROM bars WHERE source = 'P')
SELECT symbol, date, 'F' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT symbol, date, 'P' AS only_in FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""",
)
def q_dates_only(spark: SparkSession, sf: str) -> DataFrame:
    return crossval.dates_only(ADAPTERS["ord"](spark, sf), "F", "P")


# ---------------------------------------------------------------- checks

from barlake.functions.calendar import last_trading_day as _ltd  # noqa: E402
from barlake.functions.calendar import trading_days_between as _tdb  # noqa: E402
from barlake.functions.calendar_frames import trading_calendar  # noqa: E402
from barlake.operators import checks  # noqa: E402
from barlake.plans.table_bars import with_defects  # noqa: E402

CHECK_SYMBOLS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-ABSENT"]
STALE_AS_OF = ["2001-07-20", "2001-08-02", "2001-08-04", "2001-08-13", "2001-09-03"]
RUN_AS_OF = "2001-08-04"


def _profile_oracle(adapter: str, defects: bool, symbols: list[str] | None) -> str:
    syms = (
        f"SELECT * FROM (VALUES {', '.join(f'({chr(39)}{s}{chr(39)})' for s in symbols)}) t(symbol)"
        if symbols
        else "SELECT DISTINCT symbol FROM bars"
    )
    return f"""
{bars_cte(adapter, defects=defects)},
syms AS ({syms}),
agg AS (
  SELECT symbol, count(*) AS n_rows,
         count(*) FILTER (WHERE open < 0 OR high < 0 OR low < 0 OR close < 0) AS n_negative,
         count(*) FILTER (WHERE high < low) AS n_high_low,
         count(*) FILTER (WHERE close = 0) AS n_zero_close,
         count(*) FILTER (WHERE volume < 0) AS n_negative_volume,
         count(*) FILTER (WHERE open = high AND high = low AND low = close) AS n_flat,
         count(*) FILTER (WHERE volume = 0 AND abs(close - open) / open > 0.01) AS n_zero_vol_move,
         count(DISTINCT date) AS n_days, min(date) AS first_date, max(date) AS latest_date
  FROM bars GROUP BY symbol),
cal AS (SELECT symbol, CAST(unnest(generate_series(first_date, latest_date, INTERVAL 1 DAY)) AS DATE) AS date FROM agg),
miss AS (SELECT symbol, date FROM cal WHERE isodow(date) <= 5 EXCEPT SELECT symbol, date FROM bars),
mruns AS (SELECT symbol, date, sum(brk) OVER (PARTITION BY symbol ORDER BY date) AS run,
                 row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
          FROM (SELECT symbol, date,
                       CASE WHEN date - lag(date) OVER (PARTITION BY symbol ORDER BY date) <= 3 THEN 0 ELSE 1 END AS brk
                FROM miss) x),
gap AS (SELECT symbol, max(n) AS longest_gap, CAST(sum(n) AS BIGINT) AS n_missing FROM (SELECT symbol, run, count(*) AS n FROM mruns GROUP BY ALL) y GROUP BY symbol),
head AS (SELECT symbol, string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS missing_dates FROM mruns WHERE rn <= 20 GROUP BY symbol),
prof AS (
  SELECT s.symbol, coalesce(a.n_rows, 0) AS n_rows,
         coalesce(a.n_negative, 0) AS n_negative, coalesce(a.n_high_low, 0) AS n_high_low,
         coalesce(a.n_zero_close, 0) AS n_zero_close, coalesce(a.n_negative_volume, 0) AS n_negative_volume,
         coalesce(a.n_flat, 0) AS n_flat, coalesce(a.n_zero_vol_move, 0) AS n_zero_vol_move,
         coalesce(a.n_days, 0) AS n_days, a.first_date, a.latest_date,
         CASE WHEN a.n_rows IS NULL THEN NULL ELSE coalesce(g.n_missing, 0) END AS n_missing,
         CAST(coalesce(g.longest_gap, 0) AS INTEGER) AS longest_gap,
         coalesce(h.missing_dates, '') AS missing_dates
  FROM syms s LEFT JOIN agg a USING (symbol) LEFT JOIN gap g USING (symbol) LEFT JOIN head h USING (symbol))"""


_GAPS_SQL = """CASE WHEN n_rows = 0 THEN 'fail' WHEN n_missing = 0 THEN 'pass' WHEN longest_gap > 3 THEN 'fail' ELSE 'warn' END AS status,
       CASE WHEN n_rows = 0 THEN 'No data for ' || symbol
            WHEN n_missing = 0 THEN printf('No gaps found (%d trading days)', n_days)
            ELSE printf('%d missing trading day(s), longest gap: %d', n_missing, longest_gap) END AS message"""
_SANITY_N = "((n_negative > 0)::INT + (n_high_low > 0)::INT + (n_zero_close > 0)::INT + (n_negative_volume > 0)::INT)"
_SANITY_SQL = f"""CASE WHEN {_SANITY_N} > 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN {_SANITY_N} = 0 THEN 'All price sanity checks passed' ELSE concat_ws('; ',
            CASE WHEN n_negative > 0 THEN printf('%d rows with negative prices', n_negative) END,
            CASE WHEN n_high_low > 0 THEN printf('%d rows where high < low', n_high_low) END,
            CASE WHEN n_zero_close > 0 THEN printf('%d rows with zero close', n_zero_close) END,
            CASE WHEN n_negative_volume > 0 THEN printf('%d rows with negative volume', n_negative_volume) END) END AS message"""
_OHLC_N = "((n_flat > 0)::INT + (n_zero_vol_move > 0)::INT)"
_OHLC_SQL = f"""CASE WHEN {_OHLC_N} > 0 THEN 'warn' ELSE 'pass' END AS status,
       CASE WHEN {_OHLC_N} = 0 THEN 'OHLC consistency checks passed' ELSE concat_ws('; ',
            CASE WHEN n_flat > 0 THEN printf('%d rows with identical OHLC (possible placeholder)', n_flat) END,
            CASE WHEN n_zero_vol_move > 0 THEN printf('%d rows with zero volume but >1%% price movement', n_zero_vol_move) END) END AS message"""


_GAPS_DETAILS = "CASE WHEN n_missing > 0 THEN '{\"missing_dates\":[\"' || replace(missing_dates, ',', '\",\"') || '\"]}' END AS details"
_SANITY_DETAILS = f"CASE WHEN {_SANITY_N} > 0 THEN '{{\"issue_count\":' || {_SANITY_N} || '}}' END AS details"
_STALE_DETAILS = """CASE WHEN days_behind IS NOT NULL THEN '{"latest_date":"' || strftime(latest_date, '%Y-%m-%d') || '","days_behind":' || days_behind || '}' END AS details"""


def _run_checks_cte(as_of: str) -> str:
    """rc: the four checks of every profile row."""
    return f"""rc AS (
  SELECT symbol, 1 AS pos, 'trading_day_gaps' AS check_name, {_GAPS_SQL}, {_GAPS_DETAILS} FROM prof
  UNION ALL SELECT symbol, 2, 'price_sanity', {_SANITY_SQL}, {_SANITY_DETAILS} FROM prof
  UNION ALL SELECT symbol, 3, 'stale_data', status, message, {_STALE_DETAILS}
            FROM (SELECT symbol, latest_date, {_stale_sql("DATE '" + as_of + "'")} FROM prof) st
  UNION ALL SELECT symbol, 4, 'ohlc_consistency', {_OHLC_SQL}, NULL FROM prof)"""


def _stale_sql(as_of: str, with_days: bool = True) -> str:
    ltd = f"({as_of} - CASE isodow({as_of}) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END)"
    db = (f"((SELECT count(*) FROM generate_series(latest_date, {ltd}, INTERVAL 1 DAY) t(d) "
          f"WHERE isodow(d) <= 5) - 1)")
    return f"""CASE WHEN n_rows = 0 THEN 'fail' WHEN {db} <= 1 THEN 'pass' WHEN {db} <= 5 THEN 'warn' ELSE 'fail' END AS status,
       CASE WHEN n_rows = 0 THEN 'No data for ' || symbol
            WHEN {db} <= 1 THEN 'Data is current (latest: ' || strftime(latest_date, '%Y-%m-%d') || ')'
            ELSE printf('Data is %d trading day(s) behind (latest: %s)', {db}, strftime(latest_date, '%Y-%m-%d')) END AS message""" + (
        f""",
       CASE WHEN n_rows = 0 THEN NULL ELSE CAST({db} AS INTEGER) END AS days_behind""" if with_days else "")


def _profile(spark, sf, adapter="ord", defects=False, symbols=None):
    bars = ADAPTERS[adapter](spark, sf)
    if defects:
        bars = with_defects(bars)
    return checks.symbol_profile(bars, symbols)


@register(
    "check_gaps",
    f"""WITH {_profile_oracle("ord", False, None)}
SELECT symbol, 'trading_day_gaps' AS check_name, {_GAPS_SQL},
       n_missing, longest_gap, n_days, missing_dates FROM prof""",
)
def q_check_gaps(spark, sf):
    out = checks.check_gaps(None, profile=_profile(spark, sf))
    return out.withColumn("missing_dates", F.array_join("missing_dates", ","))


@register(
    "check_price_sanity",
    f"""WITH {_profile_oracle("ord", True, None)}
SELECT symbol, 'price_sanity' AS check_name, {_SANITY_SQL}, CAST({_SANITY_N} AS INTEGER) AS issue_count,
       n_negative, n_high_low, n_zero_close, n_negative_volume FROM prof""",
)
def q_check_price_sanity(spark, sf):
    return checks.check_price_sanity(None, profile=_profile(spark, sf, defects=True))


@register(
    "check_ohlc_consistency",
    f"""WITH {_profile_oracle("ord", True, None)}
SELECT symbol, 'ohlc_consistency' AS check_name, {_OHLC_SQL}, n_flat, n_zero_vol_move FROM prof""",
)
def q_check_ohlc(spark, sf):
    return checks.check_ohlc_consistency(None, profile=_profile(spark, sf, defects=True))


@register(
    "check_stale",
    f"""WITH {_profile_oracle("ord", False, CHECK_SYMBOLS)},
as_ofs AS (SELECT * FROM (VALUES {", ".join(f"(DATE '{d}')" for d in STALE_AS_OF)}) t(as_of)),
p AS (SELECT * FROM prof CROSS JOIN as_ofs)
SELECT symbol, 'stale_data' AS check_name, {_stale_sql("as_of")}, latest_date, as_of FROM p""",
)
def q_check_stale(spark, sf):
    p = _profile(spark, sf, symbols=CHECK_SYMBOLS)
    p = p.withColumn("as_of", F.explode(F.array(*[F.to_date(F.lit(d)) for d in STALE_AS_OF])))
    return checks.check_stale(None, as_of=F.col("as_of"), profile=p)


_RUN_CHECKS_SQL = f"""WITH {_profile_oracle("ord", True, CHECK_SYMBOLS)},
{_run_checks_cte(RUN_AS_OF)}"""


@register("run_checks", _RUN_CHECKS_SQL + "\nSELECT symbol, CAST(pos AS INTEGER) AS pos, check_name, status, message, details FROM rc")
def q_run_checks(spark, sf):
    bars = with_defects(ADAPTERS["ord"](spark, sf))
    return checks.run_checks(bars, CHECK_SYMBOLS, as_of=RUN_AS_OF)


@register(
    "run_checks_suppliers",
    f"""WITH {_profile_oracle("sup", False, None)},
{_run_checks_cte(RUN_AS_OF)}
SELECT symbol, CAST(pos AS INTEGER) AS pos, check_name, status, message, details FROM rc""",
)
def q_run_checks_suppliers(spark, sf):
    return checks.run_checks(ADAPTERS["sup"](spark, sf), as_of=RUN_AS_OF)


def _wide_days() -> checks.Check:
    """An added check with aggregates of its own: days on which a bar closed over 5% above its open."""
    rise = (F.col("close") - F.col("open")) / F.col("open") * 100
    n = F.coalesce("n_wide_days", F.lit(0).cast("bigint"))
    return checks.Check(
        "wide_days",
        lambda as_of: {
            "status": F.when(n == 0, F.lit("pass")).otherwise(F.lit("warn")),
            "message": F.concat(n.cast("string"), F.lit(" wide days since "), F.coalesce(F.col("first_wide").cast("string"), F.lit("-"))),
            "details": F.when(n > 0, F.concat(F.lit('{"days":'), F.col("n_days").cast("string"), F.lit("}"))),
        },
        daily={"widest_bar": F.max(F.when((F.col("open") > 0) & ~F.isnan("close"), rise))},
        by_symbol={
            "n_wide_days": F.count_if(F.col("widest_bar") > 5),
            "first_wide": F.min(F.when(F.col("widest_bar") > 5, F.col("date"))),
        },
    )


@register(
    "run_checks_own",
    f"""WITH {_profile_oracle("sup", False, None)},
{_run_checks_cte(RUN_AS_OF)},
days AS (SELECT symbol, date, max(CASE WHEN open > 0 AND NOT isnan(close) THEN (close - open) / open * 100 END) AS w FROM bars GROUP BY ALL),
wide AS (SELECT symbol, count(*) FILTER (WHERE w > 5) AS n, min(date) FILTER (WHERE w > 5) AS first, count(*) AS n_days FROM days GROUP BY symbol)
SELECT symbol, CAST(pos AS INTEGER) AS pos, check_name, status, message, details FROM rc
UNION ALL
SELECT symbol, 5, 'wide_days', CASE WHEN n = 0 THEN 'pass' ELSE 'warn' END,
       n || ' wide days since ' || coalesce(CAST(first AS VARCHAR), '-'), CASE WHEN n > 0 THEN '{{"days":' || n_days || '}}' END FROM wide""",
)
def q_run_checks_own(spark, sf):
    return checks.run_checks(ADAPTERS["sup"](spark, sf), as_of=RUN_AS_OF, checks=[*checks.DEFAULT_CHECKS, _wide_days()])


@register(
    "validation_summary",
    _RUN_CHECKS_SQL
    + """
SELECT symbol,
       CASE max(CASE status WHEN 'pass' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END)
            WHEN 1 THEN 'pass' WHEN 2 THEN 'warn' ELSE 'fail' END AS status,
       count(*) FILTER (WHERE status = 'pass') AS passed,
       count(*) AS total,
       coalesce(string_agg(check_name, ', ' ORDER BY pos) FILTER (WHERE status <> 'pass'), '-') AS issues
FROM rc GROUP BY symbol""",
)
def q_validation_summary(spark, sf):
    bars = with_defects(ADAPTERS["ord"](spark, sf))
    return checks.validation_summary(bars, CHECK_SYMBOLS, as_of=RUN_AS_OF)


@register(
    "missing_days",
    f"""WITH {bars_cte("ord")},
b AS (SELECT symbol, min(date) AS s, max(date) AS e FROM bars GROUP BY symbol),
cal AS (SELECT symbol, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT symbol, date FROM cal WHERE isodow(date) <= 5
EXCEPT SELECT symbol, date FROM bars""",
)
def q_missing_days(spark, sf):
    return checks.missing_days(ADAPTERS["ord"](spark, sf))


@register(
    "trading_calendar",
    f"""WITH {bars_cte("ord")},
b AS (SELECT symbol, source, min(date) AS start, max(date) AS "end" FROM bars GROUP BY ALL
      UNION ALL SELECT DISTINCT symbol, 'reversed', DATE '2001-01-10', DATE '2001-01-01' FROM bars),
cal AS (SELECT symbol, source, start, "end", CAST(unnest(generate_series(start, "end", INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT * FROM cal WHERE isodow(date) <= 5""",
)
def q_trading_calendar(spark, sf):
    bars = ADAPTERS["ord"](spark, sf)
    bounds = bars.groupBy("symbol", "source").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    # Reversed bounds must yield no days (sequence would count down).
    rev = bars.select("symbol").distinct().select(
        "symbol", F.lit("reversed").alias("source"),
        F.to_date(F.lit("2001-01-10")).alias("start"), F.to_date(F.lit("2001-01-01")).alias("end"),
    )
    return trading_calendar(bounds.unionByName(rev))


@register(
    "last_trading_day",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
x AS (SELECT date, date - CASE isodow(date) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS last_trading_day,
             isodow(date) <= 5 AS is_trading_day FROM d)
SELECT date, last_trading_day, is_trading_day,
       CAST((SELECT count(*) FROM generate_series(DATE '2024-01-10', date, INTERVAL 1 DAY) t(g) WHERE isodow(g) <= 5) AS INTEGER)
         AS trading_days_from_jan10
FROM x""",
)
def q_last_trading_day(spark, sf):
    from barlake.functions.calendar import is_trading_day

    d = ADAPTERS["ev"](spark, sf).select("date").distinct()
    return d.select(
        "date",
        _ltd(F.col("date")).alias("last_trading_day"),
        is_trading_day(F.col("date")).alias("is_trading_day"),
        _tdb(F.to_date(F.lit("2024-01-10")), F.col("date")).alias("trading_days_from_jan10"),
    )


# ---------------------------------------------------------------- store, views, queries

from barlake.operators import query as qops  # noqa: E402
from barlake.session import scratch_path  # noqa: E402
from barlake.sources import store  # noqa: E402

_STORE_CACHE: dict[tuple[str, str], str] = {}
STORE_COLS = ["symbol", "source", "year", "date", "open", "high", "low", "close", "adjusted_close", "volume"]
_BAR_SELECT = "symbol, source, CAST(year(date) AS INTEGER) AS year, date, open, high, low, close, adjusted_close, volume"


def shared_store(spark: SparkSession, sf: str) -> str:
    """A processed dir holding ``daily_ohlcv`` (orders bars) and
    ``daily_events`` (event bars), written once per session and sf."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORE_CACHE:
        root = scratch_path(spark, "store", unique=True)
        store.write_bars(ADAPTERS["ord"](spark, sf), root)
        store.write_bars(ADAPTERS["ev"](spark, sf), root, "daily_events")
        _STORE_CACHE[key] = root
    return _STORE_CACHE[key]


def _store_view(spark, sf, name="daily_ohlcv"):
    store.register_views(spark, shared_store(spark, sf))
    return spark.table(name)


@register("write_roundtrip", f"WITH {bars_cte('ord')} SELECT {_BAR_SELECT} FROM bars")
def q_write_roundtrip(spark, sf):
    root = scratch_path(spark, "roundtrip", unique=True)
    store.write_bars(ADAPTERS["ord"](spark, sf), root)
    return store.read_store(spark, root).select(*STORE_COLS)


@register(
    "partition_counts",
    f"""WITH {bars_cte('li')}
SELECT symbol, source, CAST(year(date) AS INTEGER) AS year, count(*) AS rows FROM bars GROUP BY ALL""",
)
def q_partition_counts(spark, sf):
    root = scratch_path(spark, "partitions", unique=True)
    return store.write_bars(ADAPTERS["li"](spark, sf), root)


@register(
    "reprocess_idempotent",
    f"""WITH {bars_cte('ord')}
SELECT {_BAR_SELECT} FROM bars WHERE year(date) < 1998 OR date >= DATE '1998-07-01'""",
)
def q_reprocess(spark, sf):
    # Process twice (idempotent), then re-process a shorter re-fetch: the
    # touched years are replaced whole, older years stay.
    root = scratch_path(spark, "reprocess", unique=True)
    bars = ADAPTERS["ord"](spark, sf)
    store.write_bars(bars, root)
    store.write_bars(bars, root)
    store.write_bars(bars.filter(F.col("date") >= F.lit("1998-07-01").cast("date")), root)
    return store.read_store(spark, root).select(*STORE_COLS)


@register("write_roundtrip_bucketed", f"WITH {bars_cte('sup')} SELECT {_BAR_SELECT} FROM bars")
def q_write_roundtrip_bucketed(spark, sf):
    root = scratch_path(spark, "roundtrip", unique=True)
    store.write_bars(ADAPTERS["sup"](spark, sf), root, layout=store.BUCKETED, buckets=2)
    return store.read_store(spark, root, layout=store.BUCKETED).select(*STORE_COLS)


@register(
    "reprocess_bucketed",
    f"""WITH {bars_cte('sup')}
SELECT {_BAR_SELECT} FROM bars
WHERE NOT (symbol LIKE '%7' AND date < DATE '1998-07-01' AND (symbol, source, year(date)) IN (
    SELECT (symbol, source, year(date)) FROM bars WHERE symbol LIKE '%7' AND date >= DATE '1998-07-01'))""",
)
def q_reprocess_bucketed(spark, sf):
    # A re-fetch of some symbols replaces their slices only; other symbols of the same directories stay.
    root = scratch_path(spark, "reprocess", unique=True)
    bars = ADAPTERS["sup"](spark, sf)
    store.write_bars(bars, root, layout=store.BUCKETED, buckets=2)
    again = bars.filter("symbol LIKE '%7' AND date >= DATE '1998-07-01'")
    # Slices of 1998 and later that the shorter re-fetch still holds.
    store.write_bars(again, root, layout=store.BUCKETED, buckets=2)
    return store.read_store(spark, root, layout=store.BUCKETED).select(*STORE_COLS)


@register(
    "partition_counts_bucketed",
    f"""WITH {bars_cte('sup')}
SELECT symbol, source, CAST(year(date) AS INTEGER) AS year, count(*) AS rows FROM bars GROUP BY ALL""",
)
def q_partition_counts_bucketed(spark, sf):
    root = scratch_path(spark, "partitions", unique=True)
    return store.write_bars(ADAPTERS["sup"](spark, sf), root, layout=store.BUCKETED, buckets=2)


@register("view_scan", f"WITH {bars_cte('ord')} SELECT {_BAR_SELECT} FROM bars")
def q_view_scan(spark, sf):
    return _store_view(spark, sf).select(*STORE_COLS)


_VIEW_COLS = "date, open, high, low, close, adjusted_close, volume, ingested_at, symbol, source, year"


@register(
    "views_info",
    f"""WITH {bars_cte('ord', 'b1')}, {bars_cte('ev', 'b2')}
SELECT 'daily_events' AS name, (SELECT count(*) FROM b2) AS rows, 11 AS columns, '{_VIEW_COLS}' AS column_names,
       CAST(NULL AS VARCHAR) AS error
UNION ALL
SELECT 'daily_ohlcv', (SELECT count(*) FROM b1), 11, '{_VIEW_COLS}', NULL""",
)
def q_views_info(spark, sf):
    names = store.register_views(spark, shared_store(spark, sf))
    return store.views_info(spark, names)


@register(
    "q_latest",
    f"""WITH {bars_cte('ord')}
SELECT {_BAR_SELECT} FROM bars WHERE symbol = '3-MEDIUM' ORDER BY date DESC, source LIMIT 10""",
)
def q_latest(spark, sf):
    return qops.latest(_store_view(spark, sf), " 3-medium", rows=10).select(*STORE_COLS)


@register(
    "q_range",
    f"""WITH {bars_cte('ord')}
SELECT {_BAR_SELECT} FROM bars
WHERE symbol = '2-HIGH' AND date BETWEEN DATE '1997-03-01' AND DATE '1998-06-30'""",
)
def q_range(spark, sf):
    return qops.date_range(_store_view(spark, sf), "2-high", "1997-03-01", "1998-06-30").select(*STORE_COLS)


_PREVIEW_SQL = f"""WITH {bars_cte('ev')},
t AS (SELECT symbol, source, date, close, volume FROM bars)
SELECT *, (SELECT count(*) FROM t) AS total_rows FROM t ORDER BY date, symbol, source LIMIT 50"""


@register("q_preview_run", _PREVIEW_SQL)
def q_preview_run(spark, sf):
    _store_view(spark, sf)
    df = spark.sql("SELECT symbol, source, date, close, volume FROM daily_events")
    first = qops.preview_run(df, 50, ["date", "symbol", "source"])
    return first.rows.withColumn("total_rows", F.lit(first.total).cast("bigint"))


@register("q_preview", _PREVIEW_SQL)
def q_preview(spark, sf):
    _store_view(spark, sf)
    df = spark.sql(
        "SELECT symbol, source, date, close, volume FROM daily_events ORDER BY date, symbol, source"
    )
    return qops.preview(df, 50)


@register(
    "q_sql",
    f"""WITH {bars_cte('ord')}
SELECT symbol, source, CAST(year(date) AS INTEGER) AS year, count(*) AS n, min(low) AS min_low, max(high) AS max_high,
       CAST(sum(volume) AS BIGINT) AS volume
FROM bars WHERE date >= DATE '1996-01-01' AND source <> 'P' GROUP BY ALL""",
)
def q_sql(spark, sf):
    return qops.run_sql(
        spark,
        "SELECT symbol, source, year, count(*) AS n, min(low) AS min_low, max(high) AS max_high, "
        "sum(volume) AS volume FROM daily_ohlcv WHERE date >= :start AND source <> :src "
        "GROUP BY symbol, source, year",
        args={"start": _dt.date(1996, 1, 1), "src": "P"},
        processed_dir=shared_store(spark, sf),
    )


@register(
    "sql_two_stores",
    f"""WITH {bars_cte('ord', 'b1')}, {bars_cte('ev', 'b2')},
a AS (SELECT count(*) AS n, min(date) AS first, CAST(sum(volume) AS BIGINT) AS volume FROM b1),
b AS (SELECT count(*) AS n, min(date) AS first, CAST(sum(volume) AS BIGINT) AS volume FROM b2)
SELECT 1 AS turn, * FROM a UNION ALL SELECT 2, * FROM b UNION ALL SELECT 3, * FROM a""",
)
def q_sql_two_stores(spark, sf):
    # Two stores with views of one name, queried in turn: each answers with its own rows.
    other = scratch_path(spark, "other", unique=True)
    store.write_bars(ADAPTERS["ev"](spark, sf), other)
    sql = "SELECT CAST(:turn AS INT) AS turn, count(*) AS n, min(date) AS first, sum(volume) AS volume FROM daily_ohlcv"
    stores = [shared_store(spark, sf), other + "/", shared_store(spark, sf)]
    turns = [qops.run_sql(spark, sql, {"turn": k}, path) for k, path in enumerate(stores, 1)]
    return turns[0].union(turns[1]).union(turns[2])


@register(
    "export_csv",
    f"""WITH {bars_cte('ev')}
SELECT symbol, source, date, open, close, volume FROM bars""",
)
def q_export_csv(spark, sf):
    df = qops.run_sql(
        spark,
        "SELECT symbol, source, date, open, close, volume FROM daily_events",
        processed_dir=shared_store(spark, sf),
    )
    path = scratch_path(spark, "export", unique=True)
    store.export_csv(df, path)
    return spark.read.schema(
        "symbol string, source string, date date, open double, close double, volume bigint"
    ).option("header", True).csv(path)


# ---------------------------------------------------------------- raw tier

from barlake.operators import normalize as norm  # noqa: E402
from barlake.operators.symbols import filter_symbols, symbols_df  # noqa: E402
from barlake.plans import landing_render as LR  # noqa: E402
from barlake.plans.process import process  # noqa: E402
from barlake.plans.table_bars import INGESTED_AT, table  # noqa: E402
from barlake.sources.landing import latest_raw, list_landing, read_ingest_log  # noqa: E402
from barlake.sources.manifest import intraday_manifest, payload_manifest  # noqa: E402

NORM_COLS = ["date", "open", "high", "low", "close", "adjusted_close", "volume", "source", "symbol"]
PROVIDERS = ["yfinance", "stooq", "alpha_vantage"]
_PROVIDER_SQL = "CASE source WHEN 'F' THEN 'yfinance' WHEN 'O' THEN 'stooq' WHEN 'P' THEN 'alpha_vantage' END"
_ADJ_SQL = """CASE WHEN provider = 'stooq' THEN close
            WHEN provider = 'yfinance' AND year(date) % 4 = 3 THEN close
            WHEN provider = 'alpha_vantage' AND year(date) % 2 = 1 THEN close
            ELSE adjusted_close END"""
_PB = f"""{bars_cte('ord')},
pb AS (SELECT *, {_PROVIDER_SQL} AS provider FROM bars)"""
_NORM_SELECT = f"SELECT date, open, high, low, close, {_ADJ_SQL} AS adjusted_close, volume, provider AS source, symbol FROM pb"


def _landing(spark, sf):
    return LR.render_landing(ADAPTERS["ord"](spark, sf))


def _normalized(spark, sf, sources):
    return norm.normalize(_landing(spark, sf), sources, INGESTED_AT).bars.select(*NORM_COLS)


for _src, _code in (("yfinance", "F"), ("alpha_vantage", "P"), ("stooq", "O")):
    register(f"normalize_{_src}", f"WITH {_PB} {_NORM_SELECT} WHERE source = '{_code}'")(
        (lambda s: lambda spark, sf: _normalized(spark, sf, [s]))(_src)
    )

register("normalize_all", f"WITH {_PB} {_NORM_SELECT}")(lambda spark, sf: _normalized(spark, sf, None))


@register("normalize_quoted", f"WITH {_PB} {_NORM_SELECT}")
def q_normalize_quoted(spark, sf):
    return norm.normalize(LR.quoted(_landing(spark, sf)), None, INGESTED_AT).bars.select(*NORM_COLS)



#: Bars by the header variant of render_histories: yfinance by the symbol's first digit, alpha_vantage by its parity.
_HISTORY_ADJ_SQL = """CASE WHEN provider = 'stooq' THEN close
            WHEN provider = 'yfinance' AND CAST(symbol[1] AS INTEGER) % 4 = 3 THEN close
            WHEN provider = 'alpha_vantage' AND CAST(symbol[1] AS INTEGER) % 2 = 1 THEN close
            ELSE adjusted_close END"""
_HISTORY = f"""{_PB},
ok AS (SELECT * FROM pb WHERE provider IS NOT NULL AND NOT (provider = 'stooq' AND symbol = '5-LOW')
                          AND NOT (provider = 'alpha_vantage' AND symbol = '4-NOT SPECIFIED'))"""
_HISTORY_BARS = f"""WITH {_HISTORY}
SELECT symbol, provider AS source, CAST(year(date) AS INTEGER) AS year, date, open, high, low, close, {_HISTORY_ADJ_SQL} AS adjusted_close, volume
FROM ok"""
_LANDED: dict[tuple[str, str], str] = {}
_PROCESSED: dict[tuple[str, str], object] = {}


def _landed(spark: SparkSession, sf: str) -> str:
    """A landing tier of files, written once per session and sf: each symbol's
    whole history, an older payload, sidecars (one of them cut short) and an intraday file."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        root = scratch_path(spark, "raw", unique=True)
        payloads = LR.render_histories(ADAPTERS["ord"](spark, sf)).checkpoint()
        sidecars = LR.render_log_sidecars(payloads)
        cut = F.when((F.col("source") == "yfinance") & (F.col("symbol") == "1-URGENT"), F.expr("substring(body, 1, 30)")).otherwise(F.col("body"))
        intraday = payloads.select("source", "symbol", F.lit("2099-01-04_5m.csv").alias("file_name"), F.lit("Datetime,Close").alias("body")).distinct()
        LR.land(LR.with_bad_payloads(payloads).unionByName(sidecars.withColumn("body", cut)).unionByName(intraday), root)
        _LANDED[key] = root
    return _LANDED[key]


def _processed(spark: SparkSession, sf: str):
    """The result of one run of the process job over the landed files, for the queries on its parts."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PROCESSED:
        _PROCESSED[key] = process(spark, _landed(spark, sf), scratch_path(spark, "process", unique=True), PROVIDERS, CHECK_SYMBOLS, INGESTED_AT)
    return _PROCESSED[key]


@register("process_run", _HISTORY_BARS)
def q_process_run(spark, sf):
    root = scratch_path(spark, "process", unique=True)
    process(spark, _landed(spark, sf), root, PROVIDERS, CHECK_SYMBOLS, INGESTED_AT)
    return store.read_store(spark, root).select(*STORE_COLS)


@register("process_run_bucketed", _HISTORY_BARS)
def q_process_run_bucketed(spark, sf):
    root = scratch_path(spark, "process", unique=True)
    process(spark, _landed(spark, sf), root, PROVIDERS, CHECK_SYMBOLS, INGESTED_AT, layout=store.BUCKETED, buckets=4)
    return store.read_store(spark, root).select(*STORE_COLS)


@register(
    "process_written",
    f"""WITH {_HISTORY}
SELECT symbol, provider AS source, CAST(year(date) AS INTEGER) AS year, count(*) AS rows FROM ok GROUP BY ALL""",
)
def q_process_written(spark, sf):
    return _processed(spark, sf).written


@register(
    "process_rejects",
    f"""WITH {_PB}
SELECT provider AS source, symbol, CAST(max(date) AS VARCHAR) || '_daily.' || CASE WHEN provider = 'stooq' THEN 'csv' ELSE 'json' END AS file_name,
       CASE WHEN provider = 'stooq' THEN 'missing column Date' ELSE 'unparseable open' END AS error,
       CASE WHEN provider = 'stooq' THEN 0 ELSE count(*) END AS bad_rows
FROM pb WHERE (provider = 'stooq' AND symbol = '5-LOW') OR (provider = 'alpha_vantage' AND symbol = '4-NOT SPECIFIED')
GROUP BY provider, symbol""",
)
def q_process_rejects(spark, sf):
    return _processed(spark, sf).rejects


_GRID = f"""grid AS (SELECT * FROM (VALUES {", ".join(f"('{p}')" for p in PROVIDERS)}) a(source)
         CROSS JOIN (VALUES {", ".join(f"('{s}')" for s in CHECK_SYMBOLS)}) b(symbol))"""


@register(
    "process_missing",
    f"""WITH {_PB}, {_GRID}
SELECT source, symbol FROM grid EXCEPT SELECT provider, symbol FROM pb""",
)
def q_process_missing(spark, sf):
    return _processed(spark, sf).missing


@register(
    "latest_landed",
    f"""WITH {_PB}, {_GRID},
files AS (SELECT provider AS source, symbol, max(date) AS d, CASE WHEN provider = 'alpha_vantage' THEN 'json' ELSE 'csv' END AS ext
          FROM pb GROUP BY ALL)
SELECT g.source, g.symbol, CAST(f.d AS VARCHAR) || '_daily.' || f.ext AS file_name, f.d IS NOT NULL AS found
FROM grid g LEFT JOIN files f USING (source, symbol)""",
)
def q_latest_landed(spark, sf):
    return latest_raw(list_landing(spark, _landed(spark, sf)), PROVIDERS, CHECK_SYMBOLS)


@register(
    "latest_raw",
    f"""WITH {_PB},
files AS (SELECT provider AS source, symbol, max(year(date)) AS y,
                 CASE WHEN provider = 'alpha_vantage' THEN 'json' ELSE 'csv' END AS ext FROM pb GROUP BY ALL),
grid AS (SELECT * FROM (VALUES {", ".join(f"('{p}')" for p in PROVIDERS)}) a(source)
         CROSS JOIN (VALUES {", ".join(f"('{s}')" for s in CHECK_SYMBOLS)}) b(symbol))
SELECT g.source, g.symbol, CAST(f.y AS VARCHAR) || '-12-31_daily.' || f.ext AS file_name, f.y IS NOT NULL AS found
FROM grid g LEFT JOIN files f USING (source, symbol)""",
)
def q_latest_raw(spark, sf):
    landing = _landing(spark, sf)
    listing = landing.unionByName(LR.render_sidecars(landing))
    intraday = landing.select("source", "symbol").distinct().select(
        "source", "symbol",
        F.when(F.col("source") == "alpha_vantage", F.lit("2002-01-04_5min.json"))
        .otherwise(F.lit("2002-01-04_5m.csv")).alias("file_name"),
        F.lit("").alias("body"),
    )
    listing = listing.unionByName(intraday).select("source", "symbol", "file_name")
    return latest_raw(listing, PROVIDERS, CHECK_SYMBOLS)


MANIFEST_START, MANIFEST_END = "1996-03-01", "2000-06-30"


_MANIFEST_SQL = f"""WITH {_PB},
f AS (SELECT provider AS source, symbol, year(date) AS y, count(*) AS n, min(date) AS d0, max(date) AS d1,
             count(*) FILTER (WHERE date BETWEEN DATE '{MANIFEST_START}' AND DATE '{MANIFEST_END}') AS n_in,
             min(date) FILTER (WHERE date BETWEEN DATE '{MANIFEST_START}' AND DATE '{MANIFEST_END}') AS d0_in,
             max(date) FILTER (WHERE date BETWEEN DATE '{MANIFEST_START}' AND DATE '{MANIFEST_END}') AS d1_in
      FROM pb GROUP BY ALL),
k AS (SELECT *, CASE WHEN source = 'stooq' AND y = 1997 THEN 'limit_exceeded'
                     WHEN source = 'stooq' AND y = 1999 THEN 'no_data'
                     WHEN source = 'alpha_vantage' AND y = 1996 THEN 'rate_limit'
                     WHEN source = 'alpha_vantage' AND y = 2000 THEN 'api_error'
                     WHEN source = 'yfinance' AND y = 1998 THEN 'no_data' END AS error_kind FROM f)
SELECT source, symbol,
       CAST(y AS VARCHAR) || '-12-31_daily.' || CASE WHEN source = 'alpha_vantage' THEN 'json' ELSE 'csv' END AS file_name,
       'daily' AS kind, CAST(NULL AS VARCHAR) AS interval, error_kind,
       CASE error_kind
         WHEN 'limit_exceeded' THEN 'Stooq daily hit limit exceeded for ' || symbol
         WHEN 'rate_limit' THEN 'AV rate limit hit: Thank you for using the API.'
         WHEN 'api_error' THEN 'AV API error: Invalid API call.'
         WHEN 'no_data' THEN CASE WHEN source = 'stooq' THEN 'No data from Stooq for ' ELSE 'No data returned for ' END
                             || symbol || ' ({MANIFEST_START} to {MANIFEST_END})' END AS error,
       CASE WHEN error_kind IS NULL THEN CASE WHEN source = 'alpha_vantage' THEN n_in ELSE n END END AS rows_received,
       CASE WHEN error_kind IS NULL THEN CASE WHEN source = 'alpha_vantage' THEN coalesce(d0_in, DATE '{MANIFEST_START}') ELSE d0 END END AS start_date,
       CASE WHEN error_kind IS NULL THEN CASE WHEN source = 'alpha_vantage' THEN coalesce(d1_in, DATE '{MANIFEST_END}') ELSE d1 END END AS end_date,
       CASE WHEN source = 'stooq' THEN lower(symbol) || '.us' END AS provider_symbol,
       '{MANIFEST_START.replace("-", "")}' AS request_start, '{MANIFEST_END.replace("-", "")}' AS request_end
FROM k"""


@register("payload_manifest", _MANIFEST_SQL)
def q_payload_manifest(spark, sf):
    return payload_manifest(LR.with_payload_errors(_landing(spark, sf)), MANIFEST_START, MANIFEST_END)


@register("payload_manifest_quoted", _MANIFEST_SQL)
def q_payload_manifest_quoted(spark, sf):
    return payload_manifest(LR.quoted(LR.with_payload_errors(_landing(spark, sf))), MANIFEST_START, MANIFEST_END)


@register(
    "intraday_manifest",
    """WITH e AS (SELECT event_type AS symbol, CASE WHEN user_id % 2 = 0 THEN '5' ELSE '1h' END AS tok,
                  CAST(ts AS DATE) AS day, time_bucket(INTERVAL 5 MINUTE, ts) AS b FROM events),
g AS (SELECT symbol, tok, day, count(DISTINCT b) AS n FROM e GROUP BY ALL)
SELECT 'alpha_vantage' AS source, symbol,
       strftime(day, '%Y-%m-%d') || '_' || CASE tok WHEN '5' THEN '5min' ELSE '1h' END || '.json' AS file_name,
       'intraday' AS kind, CASE tok WHEN '5' THEN '5min' ELSE '1h' END AS interval,
       CASE WHEN tok = '1h' THEN 'invalid_interval' END AS error_kind,
       CASE WHEN tok = '1h' THEN 'Invalid interval ''1h''. Valid: [''15min'', ''1min'', ''30min'', ''5min'', ''60min'']' END AS error,
       CASE WHEN tok = '5' THEN n END AS rows_received,
       CASE WHEN tok = '5' THEN day END AS start_date, CASE WHEN tok = '5' THEN day END AS end_date
FROM g
UNION ALL
SELECT 'yfinance', symbol, strftime(day, '%Y-%m-%d') || '_' || CASE tok WHEN '5' THEN '5m' ELSE '1h' END || '.csv',
       'intraday', CASE tok WHEN '5' THEN '5m' ELSE '1h' END, NULL, NULL, n, day, day
FROM g
UNION ALL
SELECT 'stooq', symbol, strftime(day, '%Y-%m-%d') || '_5m.csv', 'intraday', '5m', 'unsupported',
       'Stooq does not support intraday data via CSV download. Use yfinance or Alpha Vantage for intraday.', NULL, NULL, NULL
FROM g WHERE tok = '5'""",
)
def q_intraday_manifest(spark, sf):
    return intraday_manifest(LR.render_intraday(table(spark, sf, "events")))


@register(
    "symbol_filter",
    f"""WITH {bars_cte('ord')}
SELECT date, open, high, low, close, adjusted_close, volume, source, symbol FROM bars
WHERE symbol IN ('1-URGENT', '3-MEDIUM', '9-ABSENT')""",
)
def q_symbol_filter(spark, sf):
    wanted = symbols_df(spark, " 1-urgent, 3-medium ,, 9-absent ")
    return filter_symbols(ADAPTERS["ord"](spark, sf), wanted).select(*NORM_COLS)


@register(
    "dates_union",
    f"""WITH {bars_cte("ord")}
SELECT symbol, date FROM bars WHERE source = 'O'
UNION
SELECT symbol, date FROM bars WHERE source = 'P'
""",
)
def q_dates_union(spark: SparkSession, sf: str) -> DataFrame:
    return crossval.dates_union(ADAPTERS["ord"](spark, sf), "O", "P")


@register(
    "ingest_log",
    f"""WITH {_PB},
spans AS (SELECT provider AS source, symbol, min(date) AS b, max(date) AS e FROM pb WHERE provider IN ('yfinance', 'stooq') GROUP BY ALL),
files AS (SELECT source, symbol, e AS stamp FROM spans
          UNION ALL SELECT source, symbol, b + CAST(floor((e - b) / 2) AS INTEGER) FROM spans),
logs AS (SELECT f.source, f.symbol, f.stamp, min(date) AS start_date, max(date) AS end_date, count(*) AS rows,
                f.source = 'yfinance' AND f.symbol = '1-URGENT' AS bad
         FROM files f JOIN pb ON pb.provider = f.source AND pb.symbol = f.symbol AND pb.date <= f.stamp GROUP BY ALL)
SELECT CASE WHEN NOT bad THEN source END AS source, CASE WHEN NOT bad THEN symbol END AS symbol,
       CASE WHEN NOT bad AND source = 'stooq' THEN lower(symbol) || '.us' END AS stooq_symbol,
       CASE WHEN NOT bad THEN start_date END AS start_date, CASE WHEN NOT bad THEN end_date END AS end_date,
       CASE WHEN NOT bad THEN rows END AS rows, CASE WHEN NOT bad THEN strftime(stamp, '%Y-%m-%d') || ' 18:00:00' END AS fetched_at,
       bad, CAST(stamp AS VARCHAR) || '_daily.meta.json' AS file_name, source AS path_source, symbol AS path_symbol
FROM logs""",
)
def q_ingest_log(spark, sf):
    log = read_ingest_log(spark, _landed(spark, sf))
    return log.select(
        "source", "symbol", "stooq_symbol", "start_date", "end_date", "rows",
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        F.col("bad").isNotNull().alias("bad"), "file_name", "path_source", "path_symbol",
    )


_REPORT_SYMBOLS_TEXT = " 1-urgent, 2-high, 3-medium, 4-not specified, 5-low, 9-absent "
_REPORT_CHECKS_SQL = f"""WITH {_profile_oracle("ord", False, CHECK_SYMBOLS)},
{_run_checks_cte(RUN_AS_OF)}"""


@register(
    "validation_report",
    _REPORT_CHECKS_SQL
    + """
SELECT symbol,
       CASE max(CASE status WHEN 'pass' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END)
            WHEN 1 THEN 'pass' WHEN 2 THEN 'warn' ELSE 'fail' END AS status,
       count(*) FILTER (WHERE status = 'pass') AS passed,
       count(*) AS total,
       coalesce(string_agg(check_name, ', ' ORDER BY pos) FILTER (WHERE status <> 'pass'), '-') AS issues
FROM rc GROUP BY symbol""",
)
def q_validation_report(spark, sf):
    from barlake.plans.validate import validation_report

    return validation_report(spark, shared_store(spark, sf), _REPORT_SYMBOLS_TEXT, as_of=RUN_AS_OF)
