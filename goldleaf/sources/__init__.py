"""Readers, writers, and the binding of the domain tables to the supplied parquet files."""
