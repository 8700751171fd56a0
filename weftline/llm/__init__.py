"""Operators for large-scale text and training data. Nothing outside this package imports it."""
