"""Spark-native analytics over access logs, sensor readings and social posts."""
