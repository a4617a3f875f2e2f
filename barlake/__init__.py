"""barlake: daily price-bar engine on Spark.

Landed provider payloads are normalized into one canonical OHLCV schema,
stored as hive-partitioned Parquet, exposed as SQL views, checked for data
quality and cross-validated between sources. Every operator is a
DataFrame -> DataFrame function evaluated over all symbols at once.
"""

from barlake.schema import (  # noqa: F401
    BAR_COLUMNS,
    FILE_SCHEMA,
    PARTITION_COLUMNS,
    STORE_SCHEMA,
)

__all__ = ["BAR_COLUMNS", "FILE_SCHEMA", "PARTITION_COLUMNS", "STORE_SCHEMA"]
