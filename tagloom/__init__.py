"""Spark-native preparation, exploration and tagging of large article collections."""

__version__ = "0.1.0"
