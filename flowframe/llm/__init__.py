"""Operators for training-data pipelines (text corpora, vectors and web pages)."""
