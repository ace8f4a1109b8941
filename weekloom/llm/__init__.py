"""Operators for large training-data pipelines over document, label and embedding tables."""
