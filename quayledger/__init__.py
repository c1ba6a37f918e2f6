"""Port-services billing on Spark DataFrames."""
