"""Writers: partitioned target tables, append-only logs, scratch tables."""
