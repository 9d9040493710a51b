"""Readers: parquet tables and batches, JDBC, and the test fixtures."""
