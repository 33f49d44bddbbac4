"""Spark-native retail analytics: star-model views, layered pipeline, change jobs and set-based customer analytics."""
