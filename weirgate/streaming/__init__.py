"""Structured Streaming: sources, windows, and sinks by micro-batch."""
