"""Structured Streaming jobs. All sinks are Spark's own file sink: each row is written exactly once."""
