"""Operators: every function maps DataFrames to a lazy DataFrame."""
