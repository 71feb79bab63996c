"""Spark-native curation, deduplication and evaluation of web text."""
