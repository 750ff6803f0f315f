"""Intake of new Parquet files with Structured Streaming."""
