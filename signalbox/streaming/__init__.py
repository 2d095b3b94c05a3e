"""Structured Streaming: the incident message stream."""
