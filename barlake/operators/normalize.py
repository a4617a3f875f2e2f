"""Provider payloads -> canonical bars, with file-level rejects.

A landed payload is one row, so every check and parse runs per file with
array functions: the file's lines (or series entries) become an array of
parsed structs, the file's error is the first error among them (or a header
problem), and only accepted files are exploded into bars. One pass, no
shuffle, no join: a file is accepted or rejected whole (like one failed
call in the reference), and one bad payload never stops the others.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schema import (
    NORMALIZED_COLUMNS,
    SOURCE_ALPHA_VANTAGE,
    SOURCE_STOOQ,
    SOURCE_YFINANCE,
)
from barlake.sources import payloads as P

FILE_KEYS = ["source", "symbol", "file_name"]
VALUE_FIELDS = ["open", "high", "low", "close", "adjusted_close", "volume"]
REJECT_COLUMNS = FILE_KEYS + ["error", "bad_rows"]

# Provider CSV header names.
YF_DATE_HEADERS = ["Date", "Datetime"]
YF_ADJ_CLOSE_HEADERS = ["Adj Close", "Adj. Close", "Adjusted Close"]
CSV_OPEN, CSV_HIGH, CSV_LOW, CSV_CLOSE, CSV_VOLUME = "Open", "High", "Low", "Close", "Volume"


def _ts(ingested_at) -> Column:
    if ingested_at is None:
        return F.current_timestamp()
    if isinstance(ingested_at, Column):
        return ingested_at
    # A naive stamp is UTC; as a literal of text with its offset, neither the driver's nor
    # the session's zone moves it.
    if ingested_at.tzinfo is None:
        ingested_at = ingested_at.replace(tzinfo=_dt.timezone.utc)
    return F.lit(ingested_at.astimezone(_dt.timezone.utc).isoformat()).cast("timestamp")


# Per-entry expressions are written as SQL text: one JVM call builds each
# lambda instead of hundreds of Column round trips from Python.
_PARSED_NUMS = ("open", "high", "low", "close", "adjusted_close")


def _date_sql(x: str, mode: str) -> str:
    plain = f"CAST(try_to_timestamp({x}, 'yyyy-MM-dd') AS DATE)"
    if mode == "strict":
        return plain
    if mode == "utc":
        stamped = f"CAST(try_to_timestamp({x}, 'yyyy-MM-dd HH:mm:ssXXX') AS DATE)"
    else:
        # The whole stamp must parse; its own (exchange-local) date is kept.
        whole = f"coalesce(try_to_timestamp({x}, 'yyyy-MM-dd HH:mm:ssXXX'), try_to_timestamp({x}, 'yyyy-MM-dd HH:mm:ss'))"
        stamped = f"CASE WHEN {whole} IS NOT NULL THEN CAST(substring({x}, 1, 10) AS DATE) END"
    return f"CASE WHEN contains({x}, ':') THEN {stamped} ELSE {plain} END"


VOLUME_INT_OR_FLOAT = "coalesce(try_cast({x} AS BIGINT), try_cast(try_cast({x} AS DOUBLE) AS BIGINT))"
VOLUME_INT = "try_cast({x} AS BIGINT)"


def _parse_sql(date_mode: str, volume_sql: str, required: tuple) -> str:
    """``transform(texts, t -> struct(date, open, ..., volume, err))``."""
    date = _date_sql("t.t_date", date_mode)
    nums = {k: f"try_cast(t.t_{k} AS DOUBLE)" for k in _PARSED_NUMS}
    vol = volume_sql.format(x="t.t_volume")
    errs = [f"WHEN t.t_{k} IS NULL THEN 'missing field {k}'" for k in required]
    errs.append(f"WHEN t.t_date IS NULL OR {date} IS NULL THEN 'unparseable date'")
    errs += [f"WHEN t.t_{k} IS NOT NULL AND {nums[k]} IS NULL THEN 'unparseable {k}'" for k in _PARSED_NUMS]
    errs.append(f"WHEN t.t_volume IS NOT NULL AND {vol} IS NULL THEN 'unparseable volume'")
    fields = [f"'date', {date}"] + [f"'{k}', {v}" for k, v in nums.items()] + [f"'volume', {vol}"]
    fields.append(f"'err', CASE {' '.join(errs)} END")
    return f"transform(texts, t -> named_struct({', '.join(fields)}))"


def _finish_files(files: DataFrame, entries: Column, header_error: Column, source: str, date_mode: str,
                  volume_sql: str, required: tuple = ()) -> DataFrame:
    """``entries``: array of structs with t_date, t_open, ... t_volume text.
    Returns per-file rows: keys, ``error``, ``bad_rows``, ``bars`` array.

    Each array is produced by its own projection and consumed by name, so
    the optimizer never inlines (and re-evaluates) the parse; callers select
    accepted files with ``explode(when(error IS NULL, bars))`` rather than
    a filter that would be pushed below the parse.
    """
    staged = files.select(*FILE_KEYS, header_error.alias("header_error"), entries.alias("texts"))
    parsed = staged.select(*FILE_KEYS, "header_error", F.expr(_parse_sql(date_mode, volume_sql, required)).alias("bars"))
    return parsed.select(
        *FILE_KEYS,
        F.expr("coalesce(header_error, try_element_at(filter(bars, b -> b.err IS NOT NULL), 1).err)").alias("error"),
        F.expr("CAST(CASE WHEN header_error IS NOT NULL THEN size(bars) "
               "ELSE size(filter(bars, b -> b.err IS NOT NULL)) END AS BIGINT)").alias("bad_rows"),
        "bars",
        F.lit(source).alias("parsed_as"),
    )


def _cell_sql(p: str) -> str:
    return f"nullif(trim(CASE WHEN {p} > 0 THEN try_element_at(c, {p}) END), '')"


_TEXTS_SQL = (
    "transform(cells, c -> named_struct("
    f"'t_date', {_cell_sql('p_date')}, 't_open', {_cell_sql('p_open')}, 't_high', {_cell_sql('p_high')}, "
    f"'t_low', {_cell_sql('p_low')}, 't_close', {_cell_sql('p_close')}, "
    f"'t_adjusted_close', CASE WHEN p_adj > 0 THEN {_cell_sql('p_adj')} ELSE {_cell_sql('p_close')} END, "
    f"'t_volume', {_cell_sql('p_volume')}))"
)


def _pos_sql(names: list[str]) -> str:
    """1-based position of the first of ``names`` in the header, else 0."""
    expr = "0"
    for n in reversed(names):
        expr = f"CASE WHEN array_position(header, '{n}') > 0 THEN CAST(array_position(header, '{n}') AS INT) ELSE {expr} END"
    return expr


def _csv_files(raw: DataFrame, date_names: list[str], adj_names: list[str], required: list[str],
               missing_date_msg: str, source, date_mode: str, accept_empty: bool) -> DataFrame:
    f = P.csv_files(raw)
    pos = {
        "p_date": _pos_sql(date_names), "p_open": _pos_sql([CSV_OPEN]), "p_high": _pos_sql([CSV_HIGH]),
        "p_low": _pos_sql([CSV_LOW]), "p_close": _pos_sql([CSV_CLOSE]), "p_adj": _pos_sql(adj_names),
        "p_volume": _pos_sql([CSV_VOLUME]),
    }
    checks = [f"WHEN ({pos['p_date']}) = 0 THEN '{missing_date_msg}'"]
    checks += [f"WHEN array_position(header, '{n}') = 0 THEN 'missing column {n}'" for n in required]
    checks.append("WHEN exists(cells, c -> size(c) > size(header)) THEN 'more cells than columns'")
    if not accept_empty:
        checks.append("WHEN size(cells) = 0 THEN 'no data rows'")
    header_error = f"CASE {' '.join(checks)} END"
    f = f.select(
        *FILE_KEYS, F.expr(header_error).alias("header_error"), *[F.expr(e).alias(n) for n, e in pos.items()],
        "cells",
    )
    return _finish_files(f, F.expr(_TEXTS_SQL), F.col("header_error"), source, date_mode, VOLUME_INT_OR_FLOAT)


def yfinance_files(raw: DataFrame, date_mode: str = "local") -> DataFrame:
    """yfinance daily CSV: ``Date`` or ``Datetime`` first column; adjusted
    close from the first present alias header, else the close. A file with
    a header alone is rejected: it has no date to read."""
    return _csv_files(raw, YF_DATE_HEADERS, YF_ADJ_CLOSE_HEADERS, [CSV_OPEN, CSV_HIGH, CSV_LOW, CSV_CLOSE, CSV_VOLUME],
                      "missing column Datetime", SOURCE_YFINANCE, date_mode, accept_empty=False)


def stooq_files(raw: DataFrame) -> DataFrame:
    """Stooq daily CSV ``Date,Open,High,Low,Close,Volume``; no adjusted
    close, so ``adjusted_close = close``; dates strictly ``YYYY-MM-DD``."""
    return _csv_files(raw, ["Date"], [], [CSV_OPEN, CSV_HIGH, CSV_LOW, CSV_CLOSE, CSV_VOLUME],
                      "missing column Date", SOURCE_STOOQ, "strict", accept_empty=True)


def alpha_vantage_files(raw: DataFrame) -> DataFrame:
    """Alpha Vantage daily JSON: one entry per key of ``Time Series (Daily)``.
    Volume must be integer text; adjusted close falls back to the close; a
    payload without the series, or an entry without a required field, is
    rejected."""
    j = raw.select(*FILE_KEYS, P.av_json(F.col("body")).getField(P.AV_DAILY_SERIES).alias("series"))
    header_error = F.when(F.col("series").isNull() | (F.size("series") == 0),
                          F.lit(f"No '{P.AV_DAILY_SERIES}' found"))
    g = lambda k: f"e.value['{k}']"
    entries = F.expr(
        "transform(coalesce(map_entries(series), array()), e -> named_struct("
        f"'t_date', e.key, 't_open', {g(P.AV_OPEN)}, 't_high', {g(P.AV_HIGH)}, 't_low', {g(P.AV_LOW)}, "
        f"'t_close', {g(P.AV_CLOSE)}, 't_adjusted_close', coalesce({g(P.AV_ADJ_CLOSE)}, {g(P.AV_CLOSE)}), "
        f"'t_volume', {g(P.AV_VOLUME)}))"
    )
    return _finish_files(j, entries, header_error, SOURCE_ALPHA_VANTAGE, "strict", VOLUME_INT,
                         required=("open", "high", "low", "close", "volume"))


FILE_PARSERS = {
    SOURCE_YFINANCE: yfinance_files,
    SOURCE_ALPHA_VANTAGE: alpha_vantage_files,
    SOURCE_STOOQ: stooq_files,
}


def parse_files(raw: DataFrame, sources=None, date_mode: str = "local") -> DataFrame:
    """Dispatch by ``source``: per-file (keys, error, bad_rows, bars).

    An unknown requested source is an error naming the available ones.
    """
    if sources is None:
        sources = list(FILE_PARSERS)
    unknown = [s for s in sources if s not in FILE_PARSERS]
    if unknown:
        raise ValueError(f"No normalizer for source '{unknown[0]}'. Available: {list(FILE_PARSERS)}")
    def parse(s: str) -> DataFrame:
        part = raw.filter(F.col("source") == s)
        return yfinance_files(part, date_mode) if s == SOURCE_YFINANCE else FILE_PARSERS[s](part)

    parts = [parse(s) for s in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bars_of(files: DataFrame, ingested_at) -> DataFrame:
    """Explode the accepted files into canonical bars (+ symbol)."""
    ok = files.select("symbol", "parsed_as", F.explode(F.when(F.col("error").isNull(), F.col("bars"))).alias("b"))
    return ok.select(
        F.col("b.date").alias("date"),
        *[F.col(f"b.{k}").alias(k) for k in VALUE_FIELDS],
        F.col("parsed_as").alias("source"),
        _ts(ingested_at).alias("ingested_at"),
        "symbol",
    ).select(*NORMALIZED_COLUMNS)


@dataclass
class Normalized:
    files: DataFrame  # per file: keys, error, bad_rows, bars
    bars: DataFrame  # canonical columns + symbol, accepted files only
    rejects: DataFrame  # (source, symbol, file_name, error, bad_rows)


def normalize(raw: DataFrame, sources=None, ingested_at=None, date_mode: str = "local") -> Normalized:
    """Accepted bars and rejected files from payload rows
    (source, symbol, file_name, body). ``ingested_at`` is one stamp per run
    (default: now, UTC). ``date_mode="utc"`` converts offset stamps to the
    UTC date instead of keeping the exchange-local date."""
    if ingested_at is None:
        ingested_at = _dt.datetime.now(_dt.timezone.utc)
    files = parse_files(raw, sources, date_mode)
    rejected = F.when(F.col("error").isNotNull(), F.array(F.struct(*REJECT_COLUMNS)))
    rejects = files.select(F.explode(rejected).alias("r")).select("r.*")
    return Normalized(files, bars_of(files, ingested_at), rejects)


def normalize_source(raw: DataFrame, source: str, ingested_at=None) -> DataFrame:
    """Bars of one provider's accepted payloads."""
    return normalize(raw, [source], ingested_at).bars


def normalize_yfinance(raw: DataFrame, ingested_at=None) -> DataFrame:
    return normalize_source(raw, SOURCE_YFINANCE, ingested_at)


def normalize_stooq(raw: DataFrame, ingested_at=None) -> DataFrame:
    return normalize_source(raw, SOURCE_STOOQ, ingested_at)


def normalize_alpha_vantage(raw: DataFrame, ingested_at=None) -> DataFrame:
    return normalize_source(raw, SOURCE_ALPHA_VANTAGE, ingested_at)
