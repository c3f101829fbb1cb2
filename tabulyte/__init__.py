"""Dataset-level analytics operators on Spark DataFrames."""
