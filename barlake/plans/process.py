"""The process job: latest landed payload -> normalize -> partitioned write."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.normalize import normalize
from barlake.sources import store
from barlake.session import scratch_path
from barlake.sources.landing import DAILY_FILES, latest_raw, list_landing, read_chosen, select_latest
from barlake.schema import DEFAULT_DATASET

NO_RAW_FILES = "No raw files found to process."


@dataclass
class ProcessResult:
    written: DataFrame  # (symbol, source, year, rows) replaced by this run
    rejects: DataFrame  # (source, symbol, file_name, error, bad_rows)
    missing: DataFrame  # requested (source, symbol) without a daily payload


def process(
    spark: SparkSession,
    raw,
    processed_dir: str,
    sources=None,
    symbols=None,
    ingested_at=None,
    dataset: str = DEFAULT_DATASET,
    layout: str | None = None,
    buckets: int | None = None,
) -> ProcessResult:
    """Process the latest daily payload of every (source, symbol) in one job.

    ``raw`` is a landing directory or a raw DataFrame. With a directory, the
    latest files are chosen from a listing without content, and only they are
    read: the scan drops all other files before reading them (``read_chosen``).
    Files that fail to parse are reported in ``rejects`` and do not stop the
    others. A landing tier without a requested daily payload is an error.
    Re-running is idempotent (dynamic partition overwrite), and ``written``
    counts the rows of this run alone. ``layout`` and ``buckets`` are those of
    ``write_bars``.
    """
    if ingested_at is None:
        ingested_at = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(raw, str):
        try:
            listing = list_landing(spark, raw, DAILY_FILES)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(NO_RAW_FILES) from e
            raise
        # Listed once; the choice is read again below.
        path = scratch_path(spark, "latest", unique=True)
        latest_raw(listing, sources, symbols).write.parquet(path)
        keys = spark.read.parquet(path)
        found = keys.filter("found")
        if found.isEmpty():
            raise FileNotFoundError(NO_RAW_FILES)
        payloads = read_chosen(spark, raw, found)
    else:
        keys = latest_raw(raw.select("source", "symbol", "file_name"), sources, symbols)
        payloads = select_latest(raw, sources, symbols, keys)
    result = normalize(payloads, sources, ingested_at)
    written = store.write_bars(result.bars, processed_dir, dataset, layout, buckets)
    missing = keys.filter(~F.col("found")).select("source", "symbol")
    return ProcessResult(written, result.rejects, missing)
