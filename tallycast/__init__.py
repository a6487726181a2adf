"""Spark-native operators for city event streams: clean, de-duplicate, align
with sensor readings, count per collection run, forecast and serve."""
