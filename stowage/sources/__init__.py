"""Spaces kept as Parquet files."""
