"""Landing reader, normalizers, rejects and the process job on real files."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest

from barlake.operators.normalize import normalize, parse_files
from barlake.operators.symbols import resolve_symbols
from barlake.plans.process import process
from barlake.sources import store
from barlake.sources.landing import latest_raw, list_landing, read_ingest_log, read_landing

RAW = "source string, symbol string, file_name string, body string"
PRICES = "Open,High,Low,Close"


def csv(*days, header=f"Date,{PRICES},Volume"):
    """A payload with one line of own numbers for each day."""
    lines = [f"{d},{40 + k},{42.5 + k},{39.25 + k},{41 + k},{8100 + k}" for k, d in enumerate(days)]
    return "\n".join([header, *lines])


def series(**days):
    """A JSON payload; each day's entry adds to or replaces the default fields."""
    entry = {"1. open": "7.5", "2. high": "8.25", "3. low": "7.0", "4. close": "8.0", "6. volume": "350"}
    return json.dumps({"Time Series (Daily)": {d.replace("_", "-").lstrip("d"): entry | own for d, own in days.items()}})


def land(tiers, source, symbol, name, text):
    folder = tiers.raw / source / symbol
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def parsed(spark, source, *bodies, **options):
    raw = spark.createDataFrame([(source, f"S{k}", f"{k}_daily", b) for k, b in enumerate(bodies)], RAW)
    res = normalize(raw, **options)
    return sorted(res.bars.collect(), key=lambda r: (r.symbol, r.date)), {r.symbol: r.error for r in res.rejects.collect()}


def test_two_csv_providers_from_files(spark, tiers):
    land(tiers, "yfinance", "KLM", "2021-06-09_daily.csv", csv("2021-06-07", "2021-06-08", header=f"Date,{PRICES},Volume"))
    land(tiers, "stooq", "KLM", "2021-06-09_daily.csv", csv("2021-06-07", "2021-06-08"))
    res = normalize(read_landing(spark, str(tiers.raw)), ["yfinance", "stooq"], dt.datetime(2021, 6, 10))
    rows = res.bars.collect()
    assert len(rows) == 4 and res.rejects.isEmpty()
    assert all(r.adjusted_close == r.close and r.symbol == "KLM" for r in rows)
    assert dict(res.bars.dtypes)["ingested_at"] == "timestamp" and dict(res.bars.dtypes)["volume"] == "bigint"


def test_header_names_and_adjusted_close(spark):
    rows, rejects = parsed(
        spark, "yfinance",
        f"Datetime,{PRICES},Adj. Close,Volume\n2021-06-07 00:00:00-04:00,3,4,2,3.5,3.25,12.0",
        f"Date,{PRICES},Adjusted Close,Volume\n2021-06-08,3,4,2,3.5,,12",
        f"Date,{PRICES},Volume\n2021-06-09,3,4,2,3.5,12\n\n",
    )
    assert not rejects
    assert [(r.date.day, r.adjusted_close, r.volume) for r in rows] == [(7, 3.25, 12), (8, None, 12), (9, 3.5, 12)]


def test_json_series(spark):
    rows, rejects = parsed(spark, "alpha_vantage", series(d2021_06_08={}, d2021_06_07={"5. adjusted close": "6.5"}))
    assert not rejects and [(r.date.day, r.adjusted_close, r.volume) for r in rows] == [(7, 6.5, 350), (8, 8.0, 350)]


def test_one_bad_line_rejects_its_file_alone(spark):
    good = csv("2021-06-07", "2021-06-08")
    rows, rejects = parsed(spark, "stooq", good, "No data", good.replace("42.5", "n/a"), csv(), good.replace("2021-06-08", "2021-06-31"))
    assert {r.symbol for r in rows} == {"S0"}
    assert rejects == {"S1": "missing column Date", "S2": "unparseable high", "S4": "unparseable date"}
    rows, rejects = parsed(spark, "alpha_vantage", '{"Note": "later"}', series(d2021_06_07={"6. volume": "3.5"}))
    assert rows == [] and rejects == {"S0": "No 'Time Series (Daily)' found", "S1": "unparseable volume"}


def test_header_alone(spark):
    assert parsed(spark, "stooq", csv()) == ([], {})
    assert parsed(spark, "yfinance", csv()) == ([], {"S0": "no data rows"})


def test_quotes_byte_order_mark_and_extra_cells(spark):
    quoted = f'"Date","Open",High,"Low",Close,Volume\n"2021-06-07","40",42.5,39,"41",8100'
    rows, rejects = parsed(spark, "stooq", "﻿" + csv("2021-06-07"), quoted, csv("2021-06-07") + ",1,2", csv("2021-06-07") + "\n2021-06-08,1")
    assert [(r.symbol, r.open, r.close, r.volume) for r in rows] == [
        ("S0", 40.0, 41.0, 8100), ("S1", 40.0, 41.0, 8100), ("S3", 40.0, 41.0, 8100), ("S3", 1.0, None, None),
    ]
    assert rejects == {"S2": "more cells than columns"}


def test_a_stamp_must_parse_whole(spark):
    stamp = f"Datetime,{PRICES},Volume\n2021-06-07 00:00:00%s,3,4,2,3.5,12"
    rows, rejects = parsed(spark, "yfinance", stamp % "+10:00", stamp % "", stamp % " junk")
    assert [r.date for r in rows] == [dt.date(2021, 6, 7)] * 2 and rejects == {"S2": "unparseable date"}
    rows, _ = parsed(spark, "yfinance", stamp % "+10:00", date_mode="utc")
    assert rows[0].date == dt.date(2021, 6, 6)


def test_unknown_source_names_the_known_ones(spark):
    with pytest.raises(ValueError, match="Available"):
        parse_files(spark.createDataFrame([], RAW), ["carrier-pigeon"])


def test_ingested_at_does_not_depend_on_the_drivers_zone(spark):
    before = os.environ.get("TZ")
    try:
        for zone in ("America/New_York", "Asia/Tokyo"):
            os.environ["TZ"] = zone
            time.tzset()
            raw = spark.createDataFrame([("stooq", "A", "x_daily.csv", csv("2021-06-07"))], RAW)
            seconds = normalize(raw).bars.selectExpr("unix_timestamp(ingested_at)").first()[0]
            assert abs(seconds - time.time()) < 120
            fixed = normalize(raw, ingested_at=dt.datetime(2021, 6, 9, 12)).bars.selectExpr("unix_timestamp(ingested_at)").first()[0]
            assert fixed == dt.datetime(2021, 6, 9, 12, tzinfo=dt.timezone.utc).timestamp()
    finally:
        os.environ.pop("TZ", None)
        if before is not None:
            os.environ["TZ"] = before
        time.tzset()


def test_process_a_landing_directory(spark, tiers):
    land(tiers, "stooq", "KLM", "2021-06-04_daily.csv", csv("2021-06-03"))
    land(tiers, "stooq", "KLM", "2021-06-09_daily.csv", csv("2020-12-31", "2021-06-07", "2021-06-08"))
    land(tiers, "stooq", "KLM", "2021-06-10_5m.csv", "Date,Close\n")
    land(tiers, "stooq", "BAD", "2021-06-09_daily.csv", "No data")
    sidecar = {"source": "stooq", "symbol": "KLM", "stooq_symbol": "klm.us", "start_date": "2020-12-01", "end_date": "2021-06-09", "rows": 3, "fetched_at": "2021-06-09T22:00:00+00:00"}
    land(tiers, "stooq", "KLM", "2021-06-09_daily.meta.json", json.dumps(sidecar, indent=2))
    found = latest_raw(list_landing(spark, str(tiers.raw)), ["stooq"], "klm, none").collect()
    assert {(r.symbol, r.file_name, r.found) for r in found} == {("KLM", "2021-06-09_daily.csv", True), ("NONE", None, False)}
    res = process(spark, str(tiers.raw), tiers.store, ["stooq"], ["klm", "none", "bad"])
    assert sorted((r.symbol, r.year, r.rows) for r in res.written.collect()) == [("KLM", 2020, 1), ("KLM", 2021, 2)]
    assert [(r.symbol, r.error) for r in res.rejects.collect()] == [("BAD", "missing column Date")]
    assert [(r.source, r.symbol) for r in res.missing.collect()] == [("stooq", "NONE")]
    assert [(r.symbol, r.stooq_symbol, r.rows) for r in read_ingest_log(spark, str(tiers.raw)).collect()] == [("KLM", "klm.us", 3)]


def test_written_is_this_runs_alone(spark, tiers):
    land(tiers, "stooq", "AAA", "2021-06-09_daily.csv", csv("2021-06-07"))
    land(tiers, "stooq", "BBB", "2021-06-09_daily.csv", csv("2021-06-07", "2021-06-08"))
    stamp = dt.datetime(2021, 6, 9)
    for symbol, rows in (("AAA", 1), ("BBB", 2)):
        res = process(spark, str(tiers.raw), tiers.store, ["stooq"], resolve_symbols(spark, symbol), stamp)
        assert [(r.symbol, r.rows) for r in res.written.collect()] == [(symbol, rows)]
    assert store.read_store(spark, tiers.store).count() == 3


def test_nothing_landed_is_a_clear_error(spark, tiers):
    for raw in (str(tiers.raw), str(tiers.root / "nowhere")):
        with pytest.raises(FileNotFoundError, match="No raw files found"):
            process(spark, raw, tiers.store, ["stooq"], "klm")
