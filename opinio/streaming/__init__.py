"""Incremental processing of newly landed raw days (Structured Streaming)."""
