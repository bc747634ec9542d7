"""farebox: trip analytics on Spark DataFrames and Structured Streaming."""
