"""Spark-native change-data-capture engine."""
