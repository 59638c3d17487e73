"""Spark-native log transformation and stream enrichment."""
