"""Spark-native ingestion layer for a real-time warehouse (raw and detail layers)."""

__version__ = "0.1.0"
