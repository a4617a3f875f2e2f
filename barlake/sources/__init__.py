"""Sources and sinks: landed payloads, the partitioned Parquet store, views."""
