"""Table operators: DataFrames in, DataFrames out, column names as parameters."""
