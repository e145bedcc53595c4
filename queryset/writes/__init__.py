"""Writes as new versions of Parquet tables."""
