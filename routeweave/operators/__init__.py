"""Relational operators of the trip search, each a DataFrame -> DataFrame."""
