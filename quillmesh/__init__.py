"""Spark-native analytics over collections of interlinked documents."""

__version__ = "0.1.0"
