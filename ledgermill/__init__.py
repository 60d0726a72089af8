"""Spark-native engine for listing records: sources, change tracking, queries and sinks."""

__version__ = "0.1.0"
