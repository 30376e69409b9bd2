"""Text networks and document retrieval on Spark DataFrames."""
