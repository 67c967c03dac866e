"""Spark-first engine for question/answer knowledge bases and text corpora."""
