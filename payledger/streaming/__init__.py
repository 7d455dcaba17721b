"""Incremental loading (Structured Streaming)."""
