"""Shared fixtures: one local session, small own bars and folders."""

from __future__ import annotations

import datetime as dt
import os
import sys
from types import SimpleNamespace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import get_session, shared_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
STAMP = dt.datetime(2021, 7, 1, 6, 30, 0)
BAR_DDL = (
    "date date, open double, high double, low double, close double, adjusted_close double, "
    "volume bigint, source string, ingested_at timestamp, symbol string"
)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def bar(d, o=20.0, h=None, lo=None, c=None, v=700, adj=None):
    """One bar; unnamed prices follow the open."""
    h, lo, c = (o if x is None else x for x in (h, lo, c))
    return (day(d) if isinstance(d, str) else d, float(o), float(h), float(lo), float(c), float(c if adj is None else adj), v)


#: A clean week from Monday 2021-06-07, with prices of no special meaning.
WEEK = [bar(dt.date(2021, 6, 7) + dt.timedelta(days=k), 31 + k, 33.5 + k, 30.25 + k, 32 + k / 4, 4200 + 37 * k) for k in range(5)]


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="barlake-tests", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)
    yield s


def make_bars(spark, rows, symbol="QRS", source="feed"):
    return spark.createDataFrame([(*r, source, STAMP, symbol) for r in rows], BAR_DDL)


@pytest.fixture
def week(spark):
    return make_bars(spark, WEEK)


@pytest.fixture
def tiers(tmp_path):
    """Paths of an empty landing tier and an unwritten store."""
    landing = tmp_path / "landing"
    landing.mkdir()
    return SimpleNamespace(root=tmp_path, raw=landing, store=str(tmp_path / "bars"))
