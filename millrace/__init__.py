"""Spark-native preparation, analysis and audit of text corpora."""

__version__ = "0.1.0"
