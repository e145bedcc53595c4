"""Declared models over Parquet tables."""
