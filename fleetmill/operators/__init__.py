"""Operators: each takes DataFrames and options and returns a DataFrame."""
