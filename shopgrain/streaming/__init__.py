"""The row operators on Structured Streaming."""
