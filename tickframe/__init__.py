"""Market-tick analytics as DataFrame functions and Structured Streaming jobs."""
