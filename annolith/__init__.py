"""Spark-native synthetic-annotation engine."""
