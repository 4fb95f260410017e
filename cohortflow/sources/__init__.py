"""Sources, sinks and load patterns (parquet only)."""
