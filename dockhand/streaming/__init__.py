"""Structured Streaming jobs; each one uses the batch operators as they are."""
