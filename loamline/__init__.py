"""A PySpark-native engine for building and analysing large text corpora."""

__version__ = "0.1.0"
