"""sastra: Spark-native corpus curation and page-label analytics."""

__version__ = "0.1.0"
