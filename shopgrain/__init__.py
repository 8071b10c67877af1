"""Spark-native analytics over retail catalogues, reviews, demand and recommendations."""
