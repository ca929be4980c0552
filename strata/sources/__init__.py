"""Readers for landed files (CSV, JSON lines, API pages, Parquet, JDBC) and layer tables."""
