"""Operators: each takes parsed lines / records and returns a DataFrame."""
