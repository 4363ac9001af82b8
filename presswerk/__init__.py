"""presswerk: a Spark-native engine for news retrieval, curation and corpus preparation."""

__version__ = "0.1.0"
