"""Spark-native analytics over postings data: cleaning, loading, marts, serving, quality checks."""
