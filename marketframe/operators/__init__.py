"""Operators: every function maps DataFrames to a DataFrame."""
