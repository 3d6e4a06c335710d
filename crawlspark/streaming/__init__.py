"""Structured Streaming form of the fetch log."""
