"""Spark-native analytics for job-market data lakes."""
