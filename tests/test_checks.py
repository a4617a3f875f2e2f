"""Checks on small own bars, and the gap check against a DuckDB definition."""

from __future__ import annotations

import datetime as dt
import json
import random

import duckdb
import pytest
from conftest import BAR_DDL, WEEK, bar, make_bars
from pyspark.sql import functions as F

from barlake.operators import checks
from barlake.sources import store


def one(df):
    (row,) = df.collect()
    return row.asDict()


def by_check(df):
    return {r.check_name: r for r in df.collect()}


def test_clean_week_passes_every_check(week):
    got = by_check(checks.run_checks(week, as_of="2021-06-12"))
    assert {r.status for r in got.values()} == {"pass"}
    assert list(sorted(got, key=lambda k: got[k].pos)) == list(checks.CHECK_ORDER)
    assert got["trading_day_gaps"].message == "No gaps found (5 trading days)"
    assert json.loads(got["stale_data"].details) == {"latest_date": "2021-06-11", "days_behind": 0}
    assert got["price_sanity"].details is None and got["ohlc_consistency"].details is None


def test_each_kind_of_impossible_price_is_one_issue(spark):
    rows = [bar("2021-06-07", -4, 8, 2, 0, v=-3), bar("2021-06-08", 9, 7, 8, 7.5)]
    r = one(checks.check_price_sanity(make_bars(spark, rows)))
    assert (r["status"], r["issue_count"]) == ("fail", 4)
    assert r["message"].split("; ") == [
        "1 rows with negative prices", "1 rows where high < low", "1 rows with zero close", "1 rows with negative volume",
    ]
    details = by_check(checks.run_checks(make_bars(spark, rows), as_of="2021-06-09"))["price_sanity"].details
    assert json.loads(details) == {"issue_count": 4}


def test_a_single_inverted_bar_fails(spark):
    r = one(checks.check_price_sanity(make_bars(spark, [bar("2021-06-07", 9, 7, 8, 7.5)])))
    assert (r["n_high_low"], r["n_negative"], r["status"]) == (1, 0, "fail")


def test_flat_bars_and_moves_without_volume_warn(spark):
    rows = [
        bar("2021-06-07", 12),  # flat
        bar("2021-06-08", 50, 60, 49, 54, v=0),  # 8% without volume
        bar("2021-06-09", 0, 3, 0, 2, v=0),  # from zero: an infinite move
        bar("2021-06-10", 80, 81, 79, 80.4, v=0),  # 0.5%: nothing
    ]
    r = one(checks.check_ohlc_consistency(make_bars(spark, rows)))
    assert (r["status"], r["n_flat"], r["n_zero_vol_move"]) == ("warn", 1, 2)


def _duck_gaps(rows):
    """(missing, longest run, all missing dates) of each symbol, as a set difference in SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE b (symbol VARCHAR, date DATE)")
    con.executemany("INSERT INTO b VALUES (?, ?)", rows)
    got = con.execute("""
        WITH days AS (SELECT symbol, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS d FROM b GROUP BY symbol),
        gone AS (SELECT symbol, d FROM days WHERE isodow(d) < 6 EXCEPT SELECT symbol, date FROM b),
        cut AS (SELECT *, d - lag(d) OVER w > 3 AS far FROM gone WINDOW w AS (PARTITION BY symbol ORDER BY d)),
        part AS (SELECT *, count(*) FILTER (WHERE far) OVER (PARTITION BY symbol ORDER BY d) AS run FROM cut),
        run AS (SELECT symbol, run, count(*) AS n FROM part GROUP BY ALL)
        SELECT s.symbol, coalesce((SELECT count(*) FROM gone g WHERE g.symbol = s.symbol), 0),
               coalesce((SELECT max(n) FROM run r WHERE r.symbol = s.symbol), 0),
               coalesce((SELECT list(strftime(d, '%Y-%m-%d') ORDER BY d) FROM gone g WHERE g.symbol = s.symbol), [])
        FROM (SELECT DISTINCT symbol FROM b) s""").fetchall()
    return {s: (n, m, d) for s, n, m, d in got}


def test_gaps_on_random_calendars(spark):
    rnd = random.Random(41)
    rows = []
    for k in range(50):
        first = dt.date(2019, 2, 1) + dt.timedelta(days=rnd.randrange(500))
        keep = rnd.random()
        days = {first} | {first + dt.timedelta(days=i) for i in range(rnd.randrange(1, 130)) if rnd.random() < keep}
        rows += [(f"G{k}", d) for d in days]
    bars = spark.createDataFrame([(*bar(d), "feed", None, s) for s, d in rows], BAR_DDL)
    want = _duck_gaps(rows)
    for shown in (20, 3, 0, None):
        profile = checks.symbol_profile(bars, shown=shown)
        got = {r.symbol: (r.n_missing, r.longest_gap, r.missing_dates) for r in checks.check_gaps(None, profile=profile).collect()}
        assert got == {s: (n, m, d if shown is None else d[:shown]) for s, (n, m, d) in want.items()}, shown


def test_gap_levels(spark):
    def status(*days):
        r = one(checks.check_gaps(make_bars(spark, [bar(d) for d in days])))
        return r["status"], r["n_missing"], r["longest_gap"]

    # Friday and the Tuesday after: Monday is missing. A missing Thursday and Monday are one run.
    assert status("2021-06-11", "2021-06-15") == ("warn", 1, 1)
    assert status("2021-06-09", "2021-06-11", "2021-06-15") == ("warn", 2, 1)
    assert status("2021-06-08", "2021-06-10", "2021-06-11", "2021-06-14") == ("warn", 1, 1)
    assert status("2021-06-07", "2021-06-15") == ("fail", 5, 5)
    # A Saturday bar counts as a day that is there.
    assert one(checks.check_gaps(make_bars(spark, [bar("2021-06-11"), bar("2021-06-12")])))["message"] == "No gaps found (2 trading days)"


def test_stale_levels_by_as_of(week):
    want = {"2021-06-10": ("pass", -1), "2021-06-14": ("pass", 1), "2021-06-20": ("warn", 5), "2021-06-22": ("fail", 7)}
    for as_of, expected in want.items():
        r = one(checks.check_stale(week, as_of=as_of))
        assert (r["status"], r["days_behind"]) == expected, as_of


def test_symbols_as_text_list_and_frame(spark, week):
    frame = spark.createDataFrame([("QRS",), ("ZZZ",)], "symbol string")
    want = None
    for symbols in ("qrs, zzz", " QRS ,,zzz,qrs", ["qrs", "ZZZ"], frame):
        got = sorted((r.symbol, r.pos, r.status, r.message) for r in checks.run_checks(week, symbols, "2021-06-12").collect())
        want = want or got
        assert got == want and {g[0] for g in got} == {"QRS", "ZZZ"}
    assert ("ZZZ", 1, "fail", "No data for ZZZ") in want
    s = {r.symbol: (r.status, r.passed, r.total, r.issues) for r in checks.validation_summary(week, "qrs,zzz", "2021-06-12").collect()}
    assert s == {"QRS": ("pass", 4, 4, "-"), "ZZZ": ("fail", 2, 4, "trading_day_gaps, stale_data")}


def test_a_check_can_be_added_and_moved(week):
    def few_rows(as_of):
        return {"status": F.when(F.col("n_rows") < 6, F.lit("warn")).otherwise(F.lit("pass")), "message": F.format_string("%d rows", "n_rows")}

    own = (("few_rows", few_rows), *reversed(checks.DEFAULT_CHECKS))
    rows = checks.run_checks(week, as_of="2021-06-12", checks=own).orderBy("pos").collect()
    assert [r.check_name for r in rows] == ["few_rows", *reversed(checks.CHECK_ORDER)]
    assert (rows[0].status, rows[0].message, rows[0].details) == ("warn", "5 rows", None)


def test_missing_days_lists_them_all(spark):
    got = checks.missing_days(make_bars(spark, [bar("2021-01-04"), bar("2021-03-31")])).count()
    assert got == one(checks.check_gaps(make_bars(spark, [bar("2021-01-04"), bar("2021-03-31")])))["n_missing"] == 61


def test_report_over_a_store(spark, tiers, week):
    from barlake.plans.validate import validation_report
    from barlake.sources import store

    before = {r.symbol: (r.status, r.passed) for r in validation_report(spark, tiers.store, "aa, bb").collect()}
    assert before == {"AA": ("NO DATA", None), "BB": ("NO DATA", None)}
    store.write_bars(week, tiers.store)
    got = {r.symbol: (r.status, r.passed) for r in validation_report(spark, tiers.store, "qrs, bb", as_of="2021-06-12").collect()}
    assert got == {"QRS": ("pass", 4), "BB": ("fail", 2)}


def test_null_and_nan_prices(spark):
    nothing = spark.createDataFrame([(dt.date(2021, 6, 7), *[None] * 6, "feed", None, "N")], BAR_DDL)
    assert one(checks.check_price_sanity(nothing))["status"] == one(checks.check_ohlc_consistency(nothing))["status"] == "pass"
    nan = make_bars(spark, [bar("2021-06-07", 5, 6, float("nan"), 5.5)])
    assert one(checks.check_price_sanity(nan))["n_high_low"] == 1  # NaN is above every number


def _share_check(name="up_days"):
    return checks.Check(
        name,
        lambda as_of: {"status": F.when(F.col(name) > 2, F.lit("warn")).otherwise(F.lit("pass")), "message": F.col(name).cast("string")},
        daily={f"{name}_daily": F.count_if(F.col("close") > F.col("open"))},
        by_symbol={name: F.sum(f"{name}_daily")},
    )


def test_a_check_brings_its_own_aggregates_in_one_scan(spark, tiers, week):
    store.write_bars(week.union(week), tiers.store)
    out = checks.run_checks(store.read_store(spark, tiers.store), as_of="2021-06-12", checks=[*checks.DEFAULT_CHECKS, _share_check()])
    got = {r.check_name: r for r in out.collect()}
    ups = sum(2 for r in WEEK if r[4] > r[1])
    assert len(got) == 5 and got["up_days"].message == str(ups) and got["up_days"].pos == 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.find("Initial Plan")].count("FileScan parquet") == 1


def test_names_of_aggregates_must_be_free(spark, week):
    with pytest.raises(ValueError, match="taken"):
        checks.run_checks(week, checks=[_share_check(), _share_check()])
    with pytest.raises(ValueError, match="taken"):
        checks.run_checks(week, checks=[_share_check("n_flat")])
    rows = checks.run_checks(week, "QRS,NONE", "2021-06-12", checks=[_share_check()]).collect()
    assert {r.symbol: r.message for r in rows}["NONE"] is None
