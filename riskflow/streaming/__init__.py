"""Structured Streaming sources, state and sinks."""
