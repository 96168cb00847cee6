"""Spark-native analytics over advertisement logs, and operators for text at scale."""
