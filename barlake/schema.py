"""Canonical bar schema and the fixed vocabularies of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (must equal the reference for compatible data):
# canonical columns, partition columns, provider names, source keys,
# status vocabulary and the default dataset name.
BAR_COLUMNS = [
    "date",
    "open",
    "high",
    "low",
    "close",
    "adjusted_close",
    "volume",
    "source",
    "ingested_at",
]
PARTITION_COLUMNS = ["symbol", "source", "year"]
PRICE_COLUMNS = ["open", "high", "low", "close"]
DEFAULT_DATASET = "daily_ohlcv"
SOURCE_YFINANCE = "yfinance"
SOURCE_ALPHA_VANTAGE = "alpha_vantage"
SOURCE_STOOQ = "stooq"
SOURCE_KEYS = {"yf": SOURCE_YFINANCE, "av": SOURCE_ALPHA_VANTAGE, "stooq": SOURCE_STOOQ}
NO_ADJUSTED_CLOSE_SOURCES = [SOURCE_STOOQ]
STATUS_PASS, STATUS_WARN, STATUS_FAIL = "pass", "warn", "fail"
STATUS_ORDER = [STATUS_PASS, STATUS_WARN, STATUS_FAIL]
CHECK_ORDER = ["trading_day_gaps", "price_sanity", "stale_data", "ohlc_consistency"]
DEFAULT_UNIVERSE = ["AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "META", "TSLA"]

# Columns stored inside each Parquet file (partition columns live in paths).
FILE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adjusted_close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# Partition column types are pinned: inference would turn symbol=7203 into INT.
PARTITION_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)

STORE_SCHEMA = T.StructType(FILE_SCHEMA.fields + PARTITION_SCHEMA.fields)

# A normalized bar before it is written: canonical columns plus symbol.
NORMALIZED_COLUMNS = BAR_COLUMNS + ["symbol"]
