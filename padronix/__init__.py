"""Registry analytics on Spark DataFrames."""
