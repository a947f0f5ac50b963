"""Spark-native engine that compiles conversation corpora into evidence-bound knowledge tables."""
