"""Table operators: every function maps DataFrames to a DataFrame lazily."""
