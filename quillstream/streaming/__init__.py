"""Structured Streaming: sources, sinks, triggers and restart."""
