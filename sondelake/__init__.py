"""Spark-native ingest and publish engine for fixed-width sounding files."""

__version__ = "0.1.0"
