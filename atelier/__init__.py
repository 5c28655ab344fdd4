"""Spark-native catalogue data engine."""
