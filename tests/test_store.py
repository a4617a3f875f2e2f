"""Both store layouts, views, view metadata and CSV export."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from conftest import STAMP, WEEK, bar, make_bars
from pyspark.sql import functions as F

from barlake.operators import query
from barlake.sources import store


def _files(root):
    return sorted(glob.glob(f"{root}/**/*.parquet", recursive=True))


def test_hive_directories_hold_the_partition_columns(tiers, week):
    written = store.write_bars(week, tiers.store).collect()
    assert [(r.symbol, r.source, r.year, r.rows) for r in written] == [("QRS", "feed", 2021, 5)]
    (path,) = _files(tiers.store)
    assert path.split("/")[-4:-1] == ["symbol=QRS", "source=feed", "year=2021"]
    assert set(pq.ParquetFile(path).schema_arrow.names).isdisjoint({"symbol", "source", "year"})


@pytest.mark.parametrize("layout", [store.HIVE, store.BUCKETED])
def test_a_shorter_refetch_replaces_its_slices_only(spark, tiers, layout):
    rows = [*WEEK, bar("2020-12-30")]
    both = make_bars(spark, rows).union(make_bars(spark, rows, symbol="OTHER"))
    for _ in range(2):  # idempotent
        got = store.write_bars(both, tiers.store, layout=layout, buckets=1)
        assert sorted((r.symbol, r.year, r.rows) for r in got.collect()) == [("OTHER", 2020, 1), ("OTHER", 2021, 5), ("QRS", 2020, 1), ("QRS", 2021, 5)]
    got = store.write_bars(make_bars(spark, WEEK[3:]), tiers.store, layout=layout, buckets=1)
    assert [(r.symbol, r.year, r.rows) for r in got.collect()] == [("QRS", 2021, 2)]
    counts = {(r.symbol, r.year): r.rows for r in store.partition_counts(spark, tiers.store, layout=layout).collect()}
    assert counts == {("OTHER", 2020): 1, ("OTHER", 2021): 5, ("QRS", 2020): 1, ("QRS", 2021): 2}
    assert store.register_views(spark, tiers.store) == ["daily_ohlcv"]
    assert spark.sql("SELECT count(*) FROM daily_ohlcv WHERE symbol = 'QRS'").first()[0] == 3


@pytest.mark.parametrize("bound", [1_000_000, 1])
def test_a_refetch_finds_the_rows_that_stay_without_a_shuffle(spark, tiers, monkeypatch, bound):
    # As for tables beyond Spark's own bound: nothing is broadcast unless it is asked for.
    monkeypatch.setattr(store, "SLICES_BROADCAST", bound, raising=False)
    bars = make_bars(spark, WEEK)
    for name in ("AB", "CD", "EF"):
        bars = bars.union(make_bars(spark, WEEK, symbol=name))
    joined, plain = [], type(bars).join
    monkeypatch.setattr(type(bars), "join", lambda *a: joined.append(plain(*a)) or joined[-1])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.write_bars(bars, tiers.store, layout=store.BUCKETED, buckets=2)
        store.write_bars(make_bars(spark, WEEK[3:]).union(make_bars(spark, WEEK[:1], symbol="EF")), tiers.store)
        plan = joined[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    counts = {r.symbol: r.rows for r in store.partition_counts(spark, tiers.store).collect()}
    assert counts == {"QRS": 2, "AB": 5, "CD": 5, "EF": 1}
    assert plan.count("BroadcastHashJoin") == (2 if bound > 1 else 1), plan
    assert plan.count("SortMergeJoin") == (0 if bound > 1 else 1), plan


def test_unknown_layout(tiers, week):
    with pytest.raises(ValueError, match="Available"):
        store.write_bars(week, tiers.store, layout="flat")


def test_bucketed_layout_bounds_the_directories(spark, tiers):
    bars = make_bars(spark, WEEK, symbol="S0")
    for k in range(1, 12):
        bars = bars.union(make_bars(spark, WEEK, symbol=f"S{k}"))
    store.write_bars(bars, tiers.store, layout=store.BUCKETED, buckets=2)
    assert len({os.path.dirname(f) for f in _files(tiers.store)}) == 2
    assert store.read_store(spark, tiers.store, layout=store.BUCKETED).columns == store.STORE_SCHEMA.fieldNames()


def test_range_prunes_directories(spark, tiers, week):
    store.write_bars(week, tiers.store)
    df = query.date_range(store.read_store(spark, tiers.store), "qrs", "2021-06-08", "2021-06-10")
    filters = df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "symbol" in filters and "year" in filters
    assert [r.date.day for r in df.collect()] == [8, 9, 10]


def test_views_skip_folders_without_parquet(spark, tiers, week):
    assert store.register_views(spark, tiers.store) == []
    os.makedirs(f"{tiers.store}/notes")
    assert store.register_views(spark, tiers.store) == []
    store.write_bars(week, tiers.store)
    assert store.register_views(spark, tiers.store) == ["daily_ohlcv"]


def test_a_write_renews_the_views(spark, tiers, week):
    store.write_bars(week, tiers.store)
    store.register_views(spark, tiers.store)
    store.write_bars(make_bars(spark, WEEK, symbol="LATER"), tiers.store)
    store.register_views(spark, tiers.store)
    assert spark.table("daily_ohlcv").select("symbol").distinct().count() == 2


def test_symbols_that_look_like_numbers(spark, tiers):
    store.write_bars(make_bars(spark, [bar("2021-06-07")], symbol="0042"), tiers.store)
    assert store.read_store(spark, tiers.store).first().symbol == "0042"


def test_other_datasets_keep_their_columns(spark, tiers, week):
    store.write_bars(week, tiers.store)
    rows = spark.createDataFrame([(dt.date(2021, 6, 7), 2.5, "7", "s", STAMP, 2021)], "date date, v double, symbol string, source string, ts timestamp, year int")
    rows.write.partitionBy("symbol", "source", "year").parquet(f"{tiers.store}/ratios")
    assert store.register_views(spark, tiers.store, refresh=True) == ["daily_ohlcv", "ratios"]
    assert dict(spark.table("ratios").dtypes)["symbol"] == "string"


def test_views_info_is_one_plan_with_errors_beside(spark, tiers, week):
    store.write_bars(week, tiers.store)
    store.write_bars(week, tiers.store, "twin")
    names = store.register_views(spark, tiers.store)
    info = store.views_info(spark, names)
    assert info._jdf.queryExecution().executedPlan().toString().count("Scan parquet") >= 2
    assert {(r.name, r.rows, r.columns) for r in info.collect()} == {("daily_ohlcv", 5, 11), ("twin", 5, 11)}
    for f in _files(f"{tiers.store}/twin"):
        os.remove(f)
    got = {r.name: (r.rows, r.error is None) for r in store.views_info(spark, [*names, "absent"]).collect()}
    assert got == {"daily_ohlcv": (5, True), "twin": (None, False), "absent": (None, False)}


def test_export_counts_what_it_writes(spark, tiers, week):
    path = str(tiers.root / "out")
    assert store.export_csv(week.select("date", "close"), path) == 5
    assert spark.read.option("header", True).csv(path).agg(F.count("close")).first()[0] == 5


# ---------------------------------------------------------------- stores with views of one name


def _two_stores(spark, tiers):
    a, b = f"{tiers.root}/a", f"{tiers.root}/b"
    store.write_bars(make_bars(spark, WEEK[:3], symbol="AAA"), a)
    store.write_bars(make_bars(spark, WEEK, symbol="BBB"), b)
    store.write_bars(make_bars(spark, WEEK, symbol="EXTRA"), b, "daily_extra")
    return a, b


def test_each_store_answers_with_its_own_rows(spark, tiers):
    a, b = _two_stores(spark, tiers)
    ask = lambda path: tuple(query.run_sql(spark, "SELECT max(symbol), count(*) FROM daily_ohlcv", processed_dir=path).first())
    assert [ask(p) for p in (a, b, a, b + "/", a + "//")] == [("AAA", 3), ("BBB", 5), ("AAA", 3), ("BBB", 5), ("AAA", 3)]


def test_a_frame_keeps_the_store_it_was_made_from(spark, tiers):
    a, b = _two_stores(spark, tiers)
    first = query.run_sql(spark, "SELECT symbol FROM daily_ohlcv", processed_dir=a)
    query.run_sql(spark, "SELECT symbol FROM daily_ohlcv", processed_dir=b)
    assert {r.symbol for r in first.collect()} == {"AAA"}


def test_views_that_a_store_lacks_are_dropped(spark, tiers):
    a, b = _two_stores(spark, tiers)
    assert store.register_views(spark, b) == ["daily_extra", "daily_ohlcv"]
    assert store.register_views(spark, a) == ["daily_ohlcv"] and not spark.catalog.tableExists("daily_extra")
    store.register_views(spark, b)
    spark.range(3).createOrReplaceTempView("daily_extra")  # the user's own
    store.register_views(spark, a)
    assert spark.table("daily_extra").count() == 3
    spark.catalog.dropTempView("daily_extra")
    assert store.register_views(spark, f"{tiers.root}/nothing") == [] and not spark.catalog.tableExists("daily_ohlcv")


def test_a_write_by_another_spelling_is_seen(spark, tiers):
    a, _ = _two_stores(spark, tiers)
    count = lambda: query.run_sql(spark, "SELECT count(*) FROM daily_ohlcv", processed_dir=a).first()[0]
    assert count() == 3
    store.write_bars(make_bars(spark, WEEK, symbol="AAA"), f"file:{a}//")
    assert count() == 5


def test_refresh_sees_files_of_others(spark, tiers):
    a, b = _two_stores(spark, tiers)
    store.register_views(spark, a)
    source = f"{b}/daily_ohlcv/symbol=BBB"
    os.rename(source, f"{a}/daily_ohlcv/symbol=BBB")
    store.register_views(spark, a, refresh=True)
    assert spark.table("daily_ohlcv").count() == 8


# ---------------------------------------------------------------- layout descriptor


def test_another_layout_or_bucket_count_raises(spark, tiers, week):
    store.write_bars(week, tiers.store, layout=store.BUCKETED, buckets=2)
    for wrong in ({"buckets": 7}, {"layout": store.HIVE}, {"layout": store.BUCKETED, "buckets": 3}):
        with pytest.raises(ValueError, match="not"):
            store.write_bars(week, tiers.store, **wrong)
    with pytest.raises(ValueError, match="layout"):
        store.read_store(spark, tiers.store, layout=store.HIVE)
    assert store.layout_of(spark, tiers.store) == {"layout": "bucketed", "buckets": 2}
    store.write_bars(week, tiers.store)  # follows the descriptor
    assert store.read_store(spark, tiers.store).count() == 5


def test_layout_of_older_and_missing_datasets(spark, tiers, week):
    assert store.layout_of(spark, tiers.store) is None
    store.write_bars(week, tiers.store)
    os.rename(f"{tiers.store}/daily_ohlcv/_layout.json", f"{tiers.root}/descriptor")
    assert store.layout_of(spark, tiers.store) == {"layout": "hive", "buckets": None}
    store.write_bars(week, tiers.store)
    assert store.read_store(spark, tiers.store).count() == 5
    other = f"{tiers.root}/other"
    store.write_bars(week, other, layout=store.BUCKETED, buckets=2)
    os.rename(f"{other}/daily_ohlcv/_layout.json", f"{tiers.root}/descriptor2")
    assert store.read_store(spark, other).count() == 5
    with pytest.raises(ValueError, match="bucket count"):
        store.write_bars(week, other)
