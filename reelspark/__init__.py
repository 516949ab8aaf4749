"""reelspark: a Spark-native engine for time-aligned video text and hybrid retrieval."""

__version__ = "0.1.0"
