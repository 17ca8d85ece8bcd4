"""Structured Streaming forms of the engine's plans."""
