"""Readers and writers: CSV, Parquet, JSON, the run log and model versions."""
