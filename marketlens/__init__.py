"""Spark-native retail analytics: marketplace mart, data-quality rules and report queries."""

__version__ = "0.1.0"
