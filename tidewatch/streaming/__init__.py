"""Structured Streaming assembly."""
