"""Event-time analytics for click events on Spark DataFrames and Structured Streaming."""
