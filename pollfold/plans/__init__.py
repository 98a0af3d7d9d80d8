"""The jobs a user runs: each is a function from DataFrames to a DataFrame."""
