"""Layer operators: DataFrames in, DataFrames out."""
