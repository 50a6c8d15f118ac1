"""Readers and writers: all-text CSV in, Parquet between stages."""
