"""Readers: file listings, Parquet snapshots, headerless change CSVs."""
