"""Earth-observation analytics on Spark DataFrames."""
