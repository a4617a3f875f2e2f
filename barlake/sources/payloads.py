"""Parsing of landed payload bodies: CSV with per-file headers, and the
Alpha Vantage JSON object keyed by date. Pure Column expressions.

Each file carries its own header, so cells are bound by *name* through the
header's positions (``array_position``), never by position under one
file's header as a plain multi-file CSV scan would do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE_SPLIT = r"\r?\n"

# The Alpha Vantage series key format, daily key and field names.
AV_SERIES_FORMAT = "Time Series (%s)"
AV_DAILY_SERIES = "Time Series (Daily)"
AV_OPEN, AV_HIGH, AV_LOW, AV_CLOSE = "1. open", "2. high", "3. low", "4. close"
AV_ADJ_CLOSE, AV_VOLUME = "5. adjusted close", "6. volume"
AV_ERROR_KEY, AV_NOTE_KEY = "Error Message", "Note"


def csv_files(raw: DataFrame) -> DataFrame:
    """Per payload file: ``header`` (trimmed names) and ``cells`` (the cells
    of each non-blank data line), next to the raw row's columns except
    ``body``. A byte order mark at the start is dropped, and quoted cells
    lose their quotes (see ``cells_sql``)."""
    keep = [c for c in raw.columns if c != "body"]
    split = raw.select(*keep, lines(F.col("body")).alias("_all"))
    return split.select(
        *keep,
        F.expr(f"transform({cells_sql('_all[0]')}, x -> trim(x))").alias("header"),
        F.expr(f"transform({data_lines_sql('_all')}, l -> {cells_sql('l')})").alias("cells"),
    )


def without_mark(body: Column) -> Column:
    """The text without a byte order mark at its start."""
    return F.regexp_replace(body, "^\\uFEFF", "")


def lines(body: Column) -> Column:
    return F.split(without_mark(body), LINE_SPLIT)


def data_lines_sql(lines: str) -> str:
    """SQL for the non-blank lines after the header."""
    return f"filter(slice({lines}, 2, greatest(size({lines}) - 1, 1)), x -> trim(x) != '')"


def first_cells_sql(lines: str) -> str:
    """SQL for the first cell, trimmed, of each data line: what manifests read of a file."""
    return f"transform({data_lines_sql(lines)}, l -> trim({cells_sql('l')}[0]))"


def cells_sql(line: str) -> str:
    """SQL for the cells of a CSV line. A cell in double quotes may hold
    commas, and two quotes inside stand for one; lines without a quote are
    plainly split. (Quoted line breaks are not supported: payload values are
    dates and numbers.)"""
    quoted = (
        f"transform(regexp_extract_all({line}, '(?:^|,)(\\\\s*\"(?:[^\"]|\"\")*\"\\\\s*|[^,]*)', 1), "
        "c -> CASE WHEN trim(c) LIKE '\"%\"' THEN replace(substring(trim(c), 2, length(trim(c)) - 2), '\"\"', '\"') ELSE c END)"
    )
    return f"CASE WHEN contains({line}, '\"') THEN {quoted} ELSE split({line}, ',') END"


AV_SCHEMA = (
    f"struct<`{AV_ERROR_KEY}`: string, `{AV_NOTE_KEY}`: string, "
    f"`{AV_DAILY_SERIES}`: map<string, map<string, string>>>"
)


def av_json(body: Column, series_key: str = AV_DAILY_SERIES) -> Column:
    schema = AV_SCHEMA.replace(AV_DAILY_SERIES, series_key)
    return F.from_json(body, schema)
