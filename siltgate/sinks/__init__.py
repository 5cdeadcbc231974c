"""Sinks: versioned parquet tables and staged JDBC loads."""
