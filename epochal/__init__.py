"""Point-in-time analytics over two-sided event histories, written for Spark DataFrames."""
