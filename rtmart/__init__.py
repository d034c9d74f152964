"""rtmart: real-time commerce analytics on Spark DataFrames and Structured Streaming."""
