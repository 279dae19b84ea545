"""Operators for training-data pipelines over text and embedding tables."""
