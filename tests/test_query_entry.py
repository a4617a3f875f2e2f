"""Query operators and the driver contract."""

from __future__ import annotations

import datetime as dt

from conftest import SF001, bar, make_bars

import __spark_entry__ as E
from barlake.operators import query
from barlake.plans import registry
from barlake.operators.symbols import symbols_df


def test_latest_is_top_k_with_source_tiebreak(spark):
    a = make_bars(spark, [bar(dt.date(2024, 1, d), 1, 1, 1, 1) for d in (2, 3, 4)], source="b")
    b = make_bars(spark, [bar(dt.date(2024, 1, 4), 1, 1, 1, 1)], source="a")
    df = query.latest(a.unionByName(b), "qrs", rows=2)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert [(r.date.day, r.source) for r in df.collect()] == [(4, "a"), (4, "b")]


def test_preview_total(spark, week):
    rows = query.preview(week.orderBy("date"), 2).collect()
    assert len(rows) == 2 and rows[0].total_rows == 5


def test_symbols_df(spark):
    got = sorted(r.symbol for r in symbols_df(spark, " aapl, msft ,, AAPL").collect())
    assert got == ["AAPL", "MSFT"]


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert "symbol" in df.columns and "common_dates" in df.columns


def test_every_query_builds_on_sf0001(spark):
    for name, fn in registry.QUERIES.items():
        df = fn(spark, SF001)
        assert df.columns, name


def test_resolve_symbols(spark):
    from barlake.operators.symbols import resolve_symbols

    assert resolve_symbols(spark, all_universe=True).count() == 7
    assert [r.symbol for r in resolve_symbols(spark, "msft").collect()] == ["MSFT"]


def test_a_cluster_must_name_its_shared_folder():
    import pytest

    from barlake import session

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session._private_dir(master)
    assert session._private_dir("local[4]") != session._private_dir("local")


def test_preview_in_one_run(spark, week):
    first = query.preview_run(week, 2, ["date"])
    assert first.total == 5 and [r.date.day for r in first.rows.collect()] == [7, 8]
    none = query.preview_run(week.where("open < 0"), 2, ["date"])
    assert none.total == 0 and none.rows.count() == 0 and none.rows.columns == week.columns
    assert query.preview_run(week, 3).total == 5
