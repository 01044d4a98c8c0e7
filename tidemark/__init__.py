"""Tidemark: Spark-native analytics for partitioned logs of sensor and text records."""
