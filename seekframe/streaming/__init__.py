"""Structured Streaming jobs that keep the suggestion tables up to date."""
