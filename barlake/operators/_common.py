"""Shared argument handling for the operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, _dt.date):
        d = d.isoformat()
    return F.to_date(F.lit(str(d)))


def symbol_items(symbols: str | Sequence[str]) -> list[str]:
    """A comma string or a list as trimmed, upper-cased symbols: empty items
    are dropped, the first of equal ones stays. The one rule for text; symbols
    in a DataFrame are taken as they are."""
    items = symbols.split(",") if isinstance(symbols, str) else symbols
    return [s for s in dict.fromkeys(x.strip().upper() for x in items) if s]


def restrict_symbols(df: DataFrame, symbols) -> DataFrame:
    """Keep rows whose symbol is requested.

    ``symbols`` may be None (all), a comma string or short list (an ``IN``
    filter that reaches the scan as a partition filter) or a DataFrame with a
    ``symbol`` column (a left-semi join, for universes of any size).
    """
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(symbol_items(symbols)))


def restrict_dates(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Inclusive date bounds; each bound optional.

    When the frame carries the ``year`` partition column the bound is also
    stated on ``year`` so that whole year directories are pruned (Catalyst
    does not derive partition bounds from a ``date`` predicate).
    """
    has_year = "year" in df.columns
    if start is not None:
        df = df.filter(F.col(column) >= date_lit(start))
        if has_year:
            df = df.filter(F.col("year") >= F.year(date_lit(start)))
    if end is not None:
        df = df.filter(F.col(column) <= date_lit(end))
        if has_year:
            df = df.filter(F.col("year") <= F.year(date_lit(end)))
    return df


def source_list(sources: Sequence[str] | str) -> list[str]:
    """A comma string or a list as trimmed sources: empty items are dropped, the first of equal ones stays."""
    if isinstance(sources, str):
        sources = sources.split(",")
    return [s for s in dict.fromkeys(x.strip() for x in sources) if s]


def symbols_frame(bars: DataFrame, symbols) -> DataFrame:
    """The symbols to report on: requested ones, or every symbol present."""
    spark = bars.sparkSession
    if symbols is None:
        return bars.select("symbol").distinct()
    if isinstance(symbols, DataFrame):
        return symbols.select("symbol").distinct()
    return spark.createDataFrame([(s,) for s in symbol_items(symbols)], "symbol string")
