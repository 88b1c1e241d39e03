"""Readers. A table is a Parquet file or folder below a data directory, read through Spark so that any file system works."""
