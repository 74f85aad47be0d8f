"""Incremental landing -> bronze -> silver with Structured Streaming (availableNow)."""
