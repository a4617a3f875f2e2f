"""Payload manifests."""

from __future__ import annotations

import datetime as dt
import json

from barlake.sources.manifest import intraday_manifest, payload_manifest

DDL = "source string, symbol string, file_name string, body string"


def test_daily_manifest_error_classes(spark):
    series = {"2024-01-02": {}, "2024-01-05": {}, "2023-12-01": {}}
    rows = [
        ("stooq", "A", "2024-01-15_daily.csv", "No data"),
        ("stooq", "B", "2024-01-15_daily.csv", "Exceeded the daily hits limit"),
        ("stooq", "C", "2024-01-15_daily.csv", "Date,Open\n"),
        ("stooq", "D", "2024-01-15_daily.csv", "Date,Open\n2024-01-03,1\n\n2024-01-02,1\n"),
        ("alpha_vantage", "E", "2024-01-15_daily.json", json.dumps({"Note": "n"})),
        ("alpha_vantage", "F", "2024-01-15_daily.json", json.dumps({"Time Series (Daily)": series})),
        ("alpha_vantage", "G", "2024-01-15_daily.json", json.dumps({"Time Series (Daily)": {"2023-01-01": {}}})),
        ("yfinance", "H", "2024-01-15_daily.csv", ""),
        ("stooq", "I", "2024-01-15_daily.meta.json", "{}"),
    ]
    m = payload_manifest(spark.createDataFrame(rows, DDL), "2024-01-01", "2024-01-31")
    got = {r.symbol: (r.error_kind, r.rows_received, r.start_date, r.end_date) for r in m.collect()}
    d = dt.date
    assert got == {
        "A": ("no_data", None, None, None),
        "B": ("limit_exceeded", None, None, None),
        "C": ("empty", None, None, None),
        "D": (None, 3, d(2024, 1, 2), d(2024, 1, 3)),
        "E": ("rate_limit", None, None, None),
        "F": (None, 2, d(2024, 1, 2), d(2024, 1, 5)),
        "G": (None, 0, d(2024, 1, 1), d(2024, 1, 31)),
        "H": ("no_data", None, None, None),
    }
    d_row = [r for r in m.collect() if r.symbol == "D"][0]
    assert (d_row.provider_symbol, d_row.request_start, d_row.request_end) == ("d.us", "20240101", "20240131")


def test_intraday_manifest(spark):
    ts = {"2024-01-02 09:30:00": {}, "2024-01-03 16:00:00": {}}
    rows = [
        ("alpha_vantage", "A", "2024-01-04_5m.json", json.dumps({"Time Series (5min)": ts})),
        ("alpha_vantage", "B", "2024-01-04_1h.json", json.dumps({"Time Series (1h)": ts})),
        ("alpha_vantage", "C", "2024-01-04_5min.json", json.dumps({"Error Message": "bad"})),
        ("yfinance", "D", "2024-01-04_1h.csv", "Datetime,Close\n2024-01-02 09:30:00-05:00,1\n"),
        ("stooq", "E", "2024-01-04_5m.csv", "x"),
    ]
    m = intraday_manifest(spark.createDataFrame(rows, DDL))
    got = {r.symbol: (r.interval, r.error_kind, r.rows_received, r.start_date) for r in m.collect()}
    assert got == {
        "A": ("5min", None, 2, dt.date(2024, 1, 2)),
        "B": ("1h", "invalid_interval", None, None),
        "C": ("5min", "api_error", None, None),
        "D": ("1h", None, 1, dt.date(2024, 1, 2)),
        "E": ("5m", "unsupported", None, None),
    }


def _manifest(spark, source, body, **bounds):
    raw = spark.createDataFrame([(source, "QRS", "2022-01-03_daily.csv", body)], "source string, symbol string, file_name string, body string")
    return payload_manifest(raw, **bounds).first()


def test_quoted_dates_give_the_payloads_own_range(spark):
    body = '﻿"Date","Open","High","Low","Close","Volume"\r\n"2021-06-07","1","2","0.5","1.5","10"\r\n"2021-06-08",1,2,1,2,5\r\n'
    for source in ("stooq", "yfinance"):
        got = _manifest(spark, source, body, start="2020-01-01", end="2022-01-01")
        assert (str(got.start_date), str(got.end_date), got.error_kind, got.rows_received) == ("2021-06-07", "2021-06-08", None, 2)


def test_an_unreadable_date_is_an_error(spark):
    got = _manifest(spark, "stooq", "Date,Open\n07/06/2021,1\n", start="2020-01-01", end="2022-01-01")
    assert (got.error_kind, got.error, got.start_date) == ("bad_date", "Unreadable date '07/06/2021'", None)
    got = _manifest(spark, "stooq", "Date,Open\n\n \nx", start="2020-01-01", end="2022-01-01")
    assert got.error_kind == "bad_date"


def test_the_request_stands_in_only_without_rows(spark):
    raw = spark.createDataFrame(
        [("alpha_vantage", "QRS", "2022-01-03_daily.json", '{"Time Series (Daily)": {"2019-01-02": {"1. open": "1"}}}')],
        "source string, symbol string, file_name string, body string",
    )
    got = payload_manifest(raw, "2020-01-01", "2022-01-01").first()
    assert (str(got.start_date), str(got.end_date), got.rows_received) == ("2020-01-01", "2022-01-01", 0)
