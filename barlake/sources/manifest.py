"""Payload manifests: classify every landed payload as ok or error, count
its rows and find its actual date range -- the fetchers' response checks,
re-aimed at the landing tier and evaluated for all files in one pass.

All work is per-file array arithmetic on the payload's own lines or keys;
nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators._common import date_lit
from barlake.schema import SOURCE_ALPHA_VANTAGE, SOURCE_STOOQ, SOURCE_YFINANCE
from barlake.sources import payloads as P
from barlake.sources.landing import with_kind

# Provider symbol suffix, interval vocabularies, response
# markers and error texts (printf-style formats).
STOOQ_SYMBOL_SUFFIX = ".us"
AV_INTERVAL_ALIASES = {"1m": "1min", "5m": "5min", "15m": "15min", "30m": "30min", "60m": "60min"}
AV_INTERVALS = ["1min", "5min", "15min", "30min", "60min"]
YF_INTERVALS = ["1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h"]
STOOQ_NO_DATA_MARKER = "No data"
STOOQ_LIMIT_MARKER = "Exceeded"
MSG_STOOQ_NO_DATA = "No data from Stooq for %s (%s to %s)"
MSG_STOOQ_LIMIT = "Stooq daily hit limit exceeded for %s"
MSG_STOOQ_EMPTY = "Stooq returned empty data for %s"
MSG_AV_ERROR = "AV API error: %s"
MSG_AV_NOTE = "AV rate limit hit: %s"
MSG_AV_NO_DAILY = "No daily data in response for %s"
MSG_YF_NO_DATA = "No data returned for %s (%s to %s)"
MSG_INVALID_INTERVAL = "Invalid interval '%s'. Valid: %s"
MSG_AV_NO_INTRADAY = "No intraday data in response for %s"
MSG_YF_NO_INTRADAY = "No intraday data returned for %s"
MSG_STOOQ_INTRADAY = "Stooq does not support intraday data via CSV download. Use yfinance or Alpha Vantage for intraday."

MSG_BAD_DATE = "Unreadable date '%s'"

MANIFEST_COLUMNS = [
    "source", "symbol", "file_name", "kind", "interval", "error_kind", "error",
    "rows_received", "start_date", "end_date", "provider_symbol", "request_start", "request_end",
]


def _iso(c: Column) -> Column:
    """The date of a whole ISO date."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")


def _iso_stamp(c: Column) -> Column:
    """The date of a text that starts with one (intraday stamps, yfinance's offset stamps)."""
    return _iso(F.substring(c, 1, 10))


def _chain(*items) -> tuple[Column, Column]:
    kind = msg = None
    for k, cond, m in items:
        kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
        msg = F.when(cond, m) if msg is None else msg.when(cond, m)
    return kind, msg


def _range_parts(start, end) -> tuple[Column, Column]:
    s = date_lit(start).cast("string") if start is not None else F.lit("?")
    e = date_lit(end).cast("string") if end is not None else F.lit("?")
    return s, e


def _valid_list(values: list[str]) -> str:
    """Python's repr of the sorted list, as the messages print it."""
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


def payload_manifest(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Manifest of the daily payloads (``*_daily.*``, sidecars excluded).

    stooq: no data / limit exceeded / fewer than 2 lines; rows = lines - 1;
           dates from the first cell of non-blank lines (text min/max;
           a cell may stand in quotes).
    alpha_vantage: ``Error Message`` / ``Note`` / missing series; rows are
           the series keys inside [start, end]; an empty range reports the
           requested bounds, as does any payload without a data line.
    A first or last date that is no date is the error ``bad_date``.
    yfinance: no data rows; rows = data lines; dates from the first cell.
    """
    df = with_kind(raw) if "kind" not in raw.columns else raw
    df = df.filter(F.col("kind") == "daily")
    src, sym = F.col("source"), F.col("symbol")
    is_st, is_av, is_yf = src == SOURCE_STOOQ, src == SOURCE_ALPHA_VANTAGE, src == SOURCE_YFINANCE
    s_lit = date_lit(start) if start is not None else F.lit(None).cast("date")
    e_lit = date_lit(end) if end is not None else F.lit(None).cast("date")
    rs, re_ = _range_parts(start, end)

    # Each payload is parsed once, in projections that the expressions below read by name.
    names = ["source", "symbol", "file_name", "kind", "interval"]
    body = F.col("body")
    df = df.select(
        *names,
        # stooq: Python's strip(), all surrounding whitespace, newlines included
        F.when(is_st, F.regexp_replace(P.without_mark(body), r"^\s+|\s+$", "")).when(is_yf, body).alias("text"),
        F.when(is_av, P.av_json(body)).alias("json"),
    )
    df = df.select(*names, "text", "json", F.map_keys(F.col("json").getField(P.AV_DAILY_SERIES)).alias("keys"), P.lines(F.col("text")).alias("lines"))
    lo = date_lit(start).cast("string") if start is not None else F.lit("")
    inside = F.filter("keys", lambda k: (k >= lo) & (k <= date_lit(end).cast("string") if end is not None else F.lit(True)))
    df = df.select(*names, "text", "json", F.size("keys").alias("n_keys"), F.size("lines").alias("n_lines"),
                   F.when(is_av, inside).otherwise(F.expr(P.first_cells_sql("lines"))).alias("cells"))

    text, j, cells = F.col("text"), F.col("json"), F.col("cells")
    st_kind, st_msg = _chain(
        ("no_data", text.contains(STOOQ_NO_DATA_MARKER) | (text == ""), F.format_string(MSG_STOOQ_NO_DATA, sym, rs, re_)),
        ("limit_exceeded", text.contains(STOOQ_LIMIT_MARKER), F.format_string(MSG_STOOQ_LIMIT, sym)),
        ("empty", F.col("n_lines") < 2, F.format_string(MSG_STOOQ_EMPTY, sym)),
    )
    av_kind, av_msg = _chain(
        ("api_error", j.getField(P.AV_ERROR_KEY).isNotNull(), F.format_string(MSG_AV_ERROR, j.getField(P.AV_ERROR_KEY))),
        ("rate_limit", j.getField(P.AV_NOTE_KEY).isNotNull(), F.format_string(MSG_AV_NOTE, j.getField(P.AV_NOTE_KEY))),
        ("no_data", F.coalesce(F.col("n_keys"), F.lit(0)) <= 0, F.format_string(MSG_AV_NO_DAILY, sym)),
    )
    yf_kind, yf_msg = _chain(
        ("no_data", F.size(cells) == 0, F.format_string(MSG_YF_NO_DATA, sym, rs, re_)),
    )
    kind = F.when(is_st, st_kind).when(is_av, av_kind).when(is_yf, yf_kind).otherwise(F.lit("unknown_source"))
    msg = F.when(is_st, st_msg).when(is_av, av_msg).when(is_yf, yf_msg).otherwise(
        F.concat(F.lit("Unknown source "), src))
    rows = F.when(is_st, F.col("n_lines") - 1).when(is_av | is_yf, F.size(cells))
    date = lambda c: F.when(is_yf, _iso_stamp(c)).otherwise(_iso(c))
    first, last = date(F.array_min(cells)), date(F.array_max(cells))
    # A range that cannot be read is an error; the requested one stands in only where there are no rows.
    unread = F.when(first.isNull(), F.array_min(cells)).when(last.isNull(), F.array_max(cells))
    bad = kind.isNull() & (F.size(cells) > 0) & unread.isNotNull()
    kind, msg = F.when(bad, F.lit("bad_date")).otherwise(kind), F.when(bad, F.format_string(MSG_BAD_DATE, unread)).otherwise(msg)
    ok = kind.isNull()
    return df.select(
        "source", "symbol", "file_name", "kind", "interval",
        kind.alias("error_kind"),
        msg.alias("error"),
        F.when(ok, rows.cast("bigint")).alias("rows_received"),
        F.when(ok, F.coalesce(first, s_lit)).alias("start_date"),
        F.when(ok, F.coalesce(last, e_lit)).alias("end_date"),
        F.when(is_st, F.concat(F.lower(sym), F.lit(STOOQ_SYMBOL_SUFFIX))).alias("provider_symbol"),
        F.date_format(s_lit, "yyyyMMdd").alias("request_start"),
        F.date_format(e_lit, "yyyyMMdd").alias("request_end"),
    )


def intraday_manifest(raw: DataFrame) -> DataFrame:
    """Manifest of intraday payloads ``<day>_<interval>.<ext>``.

    alpha_vantage: interval aliases (1m -> 1min, ...) then validation; the
        series key is ``Time Series (<interval>)``; rows are its keys.
    yfinance: interval validation; rows are the data lines.
    stooq: intraday is unsupported.
    Dates are the first 10 characters of the smallest / largest stamp.
    """
    df = with_kind(raw) if "kind" not in raw.columns else raw
    df = df.filter(F.col("kind") == "intraday")
    src, sym, itv = F.col("source"), F.col("symbol"), F.col("interval")
    is_av, is_yf = src == SOURCE_ALPHA_VANTAGE, src == SOURCE_YFINANCE
    alias = F.create_map(*[x for kv in AV_INTERVAL_ALIASES.items() for x in map(F.lit, kv)])
    # Parsed once: the response's top level, then the keys of its series.
    names = ["source", "symbol", "file_name", "kind", "interval"]
    df = df.select(
        *names,
        F.coalesce(F.element_at(alias, itv), itv).alias("av_interval"),
        F.when(is_av, F.from_json("body", "map<string,string>")).alias("top"),
        F.when(is_yf, P.lines(F.col("body"))).alias("lines"),
    )
    av_itv, top = F.col("av_interval"), F.col("top")
    df = df.select(
        *names, "av_interval", F.element_at(top, P.AV_ERROR_KEY).alias("api_error"),
        F.when(is_av, F.json_object_keys(F.element_at(top, F.format_string(P.AV_SERIES_FORMAT, av_itv))))
        .otherwise(F.expr(P.first_cells_sql("lines"))).alias("keys"),
    )
    n_keys = F.coalesce(F.size("keys"), F.lit(0))
    av_kind, av_msg = _chain(
        ("invalid_interval", ~av_itv.isin(AV_INTERVALS),
         F.format_string(MSG_INVALID_INTERVAL, itv, F.lit(_valid_list(AV_INTERVALS)))),
        ("api_error", F.col("api_error").isNotNull(), F.format_string(MSG_AV_ERROR, F.col("api_error"))),
        ("no_data", n_keys <= 0, F.format_string(MSG_AV_NO_INTRADAY, sym)),
    )
    yf_kind, yf_msg = _chain(
        ("invalid_interval", ~itv.isin(YF_INTERVALS),
         F.format_string(MSG_INVALID_INTERVAL, itv, F.lit(_valid_list(YF_INTERVALS)))),
        ("no_data", n_keys <= 0, F.format_string(MSG_YF_NO_INTRADAY, sym)),
    )
    unsupported = F.lit(MSG_STOOQ_INTRADAY)
    kind = F.when(is_av, av_kind).when(is_yf, yf_kind).otherwise(F.lit("unsupported"))
    msg = F.when(is_av, av_msg).when(is_yf, yf_msg).otherwise(unsupported)
    ok = kind.isNull()
    return df.select(
        "source", "symbol", "file_name", "kind",
        F.when(is_av, av_itv).otherwise(itv).alias("interval"),
        kind.alias("error_kind"),
        msg.alias("error"),
        F.when(ok, n_keys.cast("bigint")).alias("rows_received"),
        F.when(ok, _iso_stamp(F.array_min("keys"))).alias("start_date"),
        F.when(ok, _iso_stamp(F.array_max("keys"))).alias("end_date"),
    )
