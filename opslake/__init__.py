"""Spark-native analytics over IT-operations tables."""
