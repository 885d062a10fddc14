"""loadweave: building-load analytics on Spark DataFrames."""
