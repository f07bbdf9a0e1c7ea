"""DataFrame operators, each a function from DataFrames to a DataFrame."""
