"""Timeline alignment and corpus processing on Spark DataFrames."""
