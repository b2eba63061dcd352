"""Change-data-capture on Structured Streaming."""
