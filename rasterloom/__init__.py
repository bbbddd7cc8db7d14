"""Spark-native analytics for scanned-document image batches."""
