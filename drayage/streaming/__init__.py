"""Structured Streaming twins of the readers and sinks."""
