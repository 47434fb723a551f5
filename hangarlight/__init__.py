"""Spark-native registry entity resolution."""
