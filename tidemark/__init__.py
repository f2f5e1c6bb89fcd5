"""Change-data-capture analytics on Spark DataFrames and Structured Streaming."""
