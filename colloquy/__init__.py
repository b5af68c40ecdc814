"""Spark-native engine for curating two-speaker conversational data."""
