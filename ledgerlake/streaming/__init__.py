"""Structured Streaming form of the incremental transactions append."""
