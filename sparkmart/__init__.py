"""Spark-native change-log to star-schema analytics."""
