"""Structured Streaming writers and supervision."""
