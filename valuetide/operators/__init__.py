"""User-level analytics operators: DataFrames in, DataFrames out."""
