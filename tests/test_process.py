"""The process job over landed files, and their sidecars."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import STAMP

from barlake.plans.process import NO_RAW_FILES, process
from barlake.sources import landing, store

CSV = "Date,Open,High,Low,Close,Volume\n2021-06-07,1,2,0.5,1.5,10\n2021-06-08,1.5,2,1,1.75,20\n"


def put(tiers, source, symbol, name, body):
    folder = tiers.raw / source / symbol
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(body if isinstance(body, bytes) else body.encode())


def test_old_payloads_are_not_read(spark, tiers):
    for k in range(30):
        put(tiers, "stooq", f"S{k}", "2021-07-01_daily.csv", CSV)
        # No reader can open it: reading any of these files would fail the job.
        put(tiers, "stooq", f"S{k}", "2021-06-01_daily.csv.gz", b"\x1f\x8b\x08 not a gzip stream")
    got = process(spark, str(tiers.raw), tiers.store, ["stooq"], ingested_at=STAMP)
    assert sorted((r.symbol, r.rows) for r in got.written.collect()) == sorted((f"S{k}", 2) for k in range(30))
    assert got.rejects.count() == 0


def test_names_that_need_escaping_are_chosen(spark, tiers):
    for symbol in ("A B", "C+D", "É%20", "x#y"):
        put(tiers, "stooq", symbol, "2021-06-01_daily.csv", CSV[:60])
        put(tiers, "stooq", symbol, "2021-07-01_daily.csv", CSV)
    keys = landing.latest_raw(landing.list_landing(spark, str(tiers.raw)))
    rows = landing.read_chosen(spark, str(tiers.raw), keys).collect()
    assert sorted((r.symbol, r.file_name, r.body) for r in rows) == sorted((s, "2021-07-01_daily.csv", CSV) for s in ("A B", "C+D", "É%20", "x#y"))


def test_written_rejects_and_missing(spark, tiers):
    put(tiers, "stooq", "GOOD", "2021-07-01_daily.csv", CSV)
    put(tiers, "stooq", "BAD", "2021-07-01_daily.csv", "No data")
    put(tiers, "stooq", "ONLY5M", "2021-07-01_5m.csv", CSV)
    got = process(spark, str(tiers.raw), tiers.store, ["stooq"], "good,bad,only5m", STAMP, layout=store.BUCKETED, buckets=3)
    assert [(r.symbol, r.rows) for r in got.written.collect()] == [("GOOD", 2)]
    assert [(r.symbol, r.error) for r in got.rejects.collect()] == [("BAD", "missing column Date")]
    assert [(r.source, r.symbol) for r in got.missing.collect()] == [("stooq", "ONLY5M")]
    assert store.layout_of(spark, tiers.store)["buckets"] == 3


def test_nothing_landed(spark, tiers):
    with pytest.raises(FileNotFoundError, match=NO_RAW_FILES):
        process(spark, f"{tiers.root}/none", tiers.store)
    put(tiers, "stooq", "ONLY5M", "2021-07-01_5m.csv", CSV)
    with pytest.raises(FileNotFoundError, match=NO_RAW_FILES):
        process(spark, str(tiers.raw), tiers.store)


def test_a_bad_sidecar_is_reported(spark, tiers):
    record = {"source": "stooq", "symbol": "AB", "stooq_symbol": "ab.us", "start_date": "2021-01-01", "end_date": "2021-06-30", "rows": 3, "fetched_at": "2021-07-01T18:00:00+00:00"}
    put(tiers, "stooq", "AB", "2021-07-01_daily.meta.json", json.dumps(record, indent=2))
    put(tiers, "stooq", "CD", "2021-07-01_daily.meta.json", json.dumps(record, indent=2)[:40])
    put(tiers, "yfinance", "EF", "2021-07-01_daily.meta.json", json.dumps({**record, "source": "yfinance", "rows": "many"}, indent=2))
    log = {r.path_symbol: r for r in landing.read_ingest_log(spark, str(tiers.raw)).collect()}
    assert log["AB"].bad is None and (log["AB"].rows, log["AB"].end_date) == (3, dt.date(2021, 6, 30))
    assert log["CD"].bad.startswith("{") and log["CD"].source is None and log["CD"].file_name == "2021-07-01_daily.meta.json"
    assert log["EF"].bad is not None and log["EF"].rows is None
