"""Table-valued operators: DataFrames in, DataFrames out."""
