"""The validation report over a processed store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.checks import validation_summary
from barlake.operators.symbols import resolve_symbols
from barlake.schema import DEFAULT_DATASET
from barlake.sources.store import register_views

NO_DATA = "NO DATA"


def validation_report(
    spark: SparkSession,
    processed_dir: str,
    symbols: str | None = None,
    as_of=None,
    universe=None,
    dataset: str = DEFAULT_DATASET,
) -> DataFrame:
    """Per symbol (the universe unless ``symbols`` is given): worst status,
    passed/total and non-passing checks, over all sources of the stored bars.

    Without a bar view (nothing processed yet) every symbol reports
    ``NO DATA`` with NULL counts; a symbol merely absent from the view gets
    the checks' own verdicts (gaps/stale fail, sanity/OHLC pass: 2/4).
    """
    syms = resolve_symbols(spark, symbols, all_universe=symbols is None, universe=universe)
    if dataset not in register_views(spark, processed_dir):
        return syms.select(
            "symbol",
            F.lit(NO_DATA).alias("status"),
            F.lit(None).cast("bigint").alias("passed"),
            F.lit(None).cast("bigint").alias("total"),
            F.lit("-").alias("issues"),
        )
    return validation_summary(spark.table(dataset), syms, as_of)
