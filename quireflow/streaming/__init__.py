"""Structured Streaming versions of preparation and scoring."""
