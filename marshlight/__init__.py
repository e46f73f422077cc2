"""Spark-native landscape mapping: cell tables, ring arrays, pixel observations and training-data pipelines."""
