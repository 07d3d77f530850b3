"""Operators: DataFrame in, DataFrame out, column names as parameters."""
