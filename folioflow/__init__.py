"""Spark-native analytics for large collections of legal and other long-form text."""
