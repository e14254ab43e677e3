"""Reading: partitioned Parquet, drifting files, landed JSON, fallbacks, listings."""
