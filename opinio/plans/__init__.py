"""User-level jobs composed from operators and sources."""
