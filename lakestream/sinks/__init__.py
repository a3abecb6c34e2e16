"""Batch writes."""
