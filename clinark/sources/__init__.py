"""Sources and sinks: raw NDJSON, Parquet, catalog tables, JDBC, test fixtures."""
