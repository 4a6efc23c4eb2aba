"""Readers and writers: raw CSV, Parquet tables, CSV results."""
