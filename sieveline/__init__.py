"""Spark-native curation of multilingual text and instruction-tuning data."""
