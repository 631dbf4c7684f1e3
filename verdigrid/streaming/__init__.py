"""Structured Streaming sources, runners and sinks."""
