"""Spark-native data-integration engine for a retail-brokerage warehouse."""
