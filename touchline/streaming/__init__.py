"""Structured Streaming sources, transforms and sinks."""
