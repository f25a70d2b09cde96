"""Spark-native document retrieval and corpus analytics."""
