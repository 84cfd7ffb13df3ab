"""Patient-day labelling jobs for Spark DataFrames."""
