"""Readers and writers: CSV, Parquet, JSON lines, catalog tables, models."""
