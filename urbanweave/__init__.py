"""City-scale map analytics on Spark DataFrames."""
