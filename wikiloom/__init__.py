"""Spark-first analytics over wiki-style document corpora."""
