"""The same statistics over unbounded input, with Structured Streaming."""
