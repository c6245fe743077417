"""Table writers for path-addressed, ``event_date``-partitioned Parquet tables."""
