"""Lodestone: table-agnostic analytics operators on Spark DataFrames."""
