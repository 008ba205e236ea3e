"""Structured Streaming versions of the incremental jobs (L1, L2)."""
