"""Structured Streaming form of the incremental load."""
