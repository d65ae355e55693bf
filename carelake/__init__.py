"""Spark-native clinical, retail and document data pipelines."""
