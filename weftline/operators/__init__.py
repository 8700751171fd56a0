"""Relational operators: DataFrame in, DataFrame out, no clock, no collect on data paths."""
