"""A PySpark-native engine for mining scientific literature at scale."""

__version__ = "0.1.0"
