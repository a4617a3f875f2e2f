"""Query operators over the bar store: latest-N, date range, preview, SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.operators._common import restrict_dates

DEFAULT_LATEST_ROWS = 10
DEFAULT_PREVIEW_ROWS = 50


def latest(bars: DataFrame, symbol: str, rows: int = DEFAULT_LATEST_ROWS) -> DataFrame:
    """The ``rows`` most recent bars of ``symbol`` (upper-cased), all sources
    mixed, date descending; ``source`` breaks date ties. A top-k: planned as
    TakeOrderedAndProject, never a full sort."""
    b = bars.filter(F.col("symbol") == F.lit(symbol.strip().upper()))
    return b.orderBy(F.col("date").desc(), F.col("source").asc_nulls_last()).limit(int(rows))


def date_range(bars: DataFrame, symbol: str, start, end) -> DataFrame:
    """Bars of ``symbol`` with ``start <= date <= end``, ordered by date.

    With the store's ``year`` column the bounds also prune year directories.
    """
    b = bars.filter(F.col("symbol") == F.lit(symbol.strip().upper()))
    return restrict_dates(b, start, end).orderBy("date", F.col("source").asc_nulls_last())


def preview(df: DataFrame, limit: int = DEFAULT_PREVIEW_ROWS) -> DataFrame:
    """The first ``limit`` rows of ``df`` plus ``total_rows`` (the size of
    the whole result), attached as a scalar subquery: one partial count per
    task, no join and no single-partition window. The query runs twice, once
    for the rows and once, pruned to a count, for the total; pass the result of
    ``checkpoint()`` where that costs more than writing it. An empty result has
    no row to carry its total, which is 0."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.limit(int(limit)).withColumn("total_rows", total)


@dataclass
class Preview:
    rows: DataFrame  # the first rows, in order
    total: int  # rows of the whole result


def preview_run(df: DataFrame, limit: int = DEFAULT_PREVIEW_ROWS, order_by=()) -> Preview:
    """The first ``limit`` rows of ``df`` by ``order_by`` (columns; else in
    the order they stand in) and the size of the whole result, 0 for an empty
    one. The query runs once, here: its rows are counted as they enter a
    top-k, whose ``limit`` rows come back."""
    count = Observation()
    order = list(order_by) or [F.monotonically_increasing_id()]
    rows = df.observe(count, F.count(F.lit(1)).alias("total")).orderBy(*order).limit(int(limit)).collect()
    return Preview(df.sparkSession.createDataFrame(rows, df.schema), int(count.get["total"]))


def run_sql(spark: SparkSession, sql: str, args: dict | None = None, processed_dir: str | None = None) -> DataFrame:
    """Spark SQL over the registered views (registered first when
    ``processed_dir`` is given). Values go through ``args`` markers
    (``:name``), never string formatting."""
    if processed_dir is not None:
        from barlake.sources.store import register_views

        register_views(spark, processed_dir)
    return spark.sql(sql, args=args) if args else spark.sql(sql)
