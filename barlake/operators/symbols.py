"""Symbol list resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.operators._common import symbol_items


def symbols_df(spark: SparkSession, symbols) -> DataFrame:
    """``"aapl, msft"`` or a list -> DataFrame(symbol): trimmed, upper-cased,
    empty items dropped, duplicates removed."""
    return spark.createDataFrame([(s,) for s in symbol_items(symbols)], "symbol string")


def resolve_symbols(spark: SparkSession, symbols: str | None = None, all_universe: bool = False,
                    universe=None) -> DataFrame:
    """The symbol set of a command: the configured universe with
    ``all_universe``, else the comma list (trimmed,
    upper-cased). Neither is an error."""
    from barlake.schema import DEFAULT_UNIVERSE

    if all_universe:
        return symbols_df(spark, list(universe or DEFAULT_UNIVERSE))
    if symbols:
        return symbols_df(spark, symbols)
    raise ValueError("Provide symbols or all_universe")


def filter_symbols(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows of the requested symbols (a left-semi join)."""
    return bars.join(symbols.select("symbol"), "symbol", "left_semi")
