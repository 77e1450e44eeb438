"""The marts: each is one function from input DataFrames to a DataFrame."""
