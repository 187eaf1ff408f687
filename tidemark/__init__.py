"""Point-in-time analytics on Spark: DataFrames in, DataFrames out."""
