"""Spark-native engine that assembles gridded and ragged tables into training data."""
