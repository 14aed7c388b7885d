"""Spark-native engine that turns nested clinical records into analytic tables."""
