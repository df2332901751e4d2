"""Quillwork: a Spark-native engine that curates loosely structured catalogue records and builds error-detection benchmarks."""
