"""Structured Streaming versions of the event aggregates."""
