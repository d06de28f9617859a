"""Sources and sinks: raw CSV feeds, the test-table tape, the Parquet warehouse store."""
