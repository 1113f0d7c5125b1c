"""Readers, writers, listings and catalog registration (I/O at the edges)."""
