"""Structured Streaming forms of the views."""
