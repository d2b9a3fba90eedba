"""The models and jobs, each a function from DataFrames to a DataFrame."""
