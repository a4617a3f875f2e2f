"""Calendar expressions against numpy's business-day functions."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from barlake.functions.calendar import last_trading_day, next_trading_day, previous_trading_day, trading_days_between
from barlake.functions.calendar_frames import trading_calendar


def test_days_between_is_numpys_count(spark):
    base = dt.date(2022, 11, 23)
    pairs = [(base + dt.timedelta(days=i), base + dt.timedelta(days=i + k)) for i in range(9) for k in range(-4, 40)]
    rows = spark.createDataFrame(pairs, "s date, e date").select("s", "e", trading_days_between(F.col("s"), F.col("e")).alias("n")).collect()
    for r in rows:
        assert r.n == max(0, int(np.busday_count(r.s, r.e + dt.timedelta(days=1)))), (r.s, r.e)


def test_neighbouring_trading_days(spark):
    days = [dt.date(2022, 11, 20) + dt.timedelta(days=i) for i in range(17)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d",
        last_trading_day(F.col("d")).alias("at_or_before"),
        next_trading_day(F.col("d")).alias("after"),
        previous_trading_day(F.col("d")).alias("before"),
    ).collect()
    for r in rows:
        one = dt.timedelta(days=1)
        assert r.at_or_before == np.busday_offset(r.d, 0, roll="backward").astype(object)
        assert r.after == np.busday_offset(r.d + one, 0, roll="forward").astype(object)
        assert r.before == np.busday_offset(r.d - one, 0, roll="backward").astype(object)


def test_reversed_bounds_give_no_days(spark):
    bounds = [("back", dt.date(2022, 11, 30), dt.date(2022, 11, 21)), ("over", dt.date(2022, 11, 25), dt.date(2022, 11, 29))]
    got = sorted((r.k, r.date.day) for r in trading_calendar(spark.createDataFrame(bounds, "k string, start date, end date")).collect())
    assert got == [("over", 25), ("over", 28), ("over", 29)]
