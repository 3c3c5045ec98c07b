"""Customer-feedback analytics on Spark DataFrames."""
