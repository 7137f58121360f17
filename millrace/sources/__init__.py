"""Readers and writers: Parquet exports, raw views, versioned SCD2 history."""
