"""Relational building blocks, DataFrame to DataFrame."""
