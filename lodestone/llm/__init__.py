"""Operators for preparing language-model training text. Nothing else in the library imports this."""
