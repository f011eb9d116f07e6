"""Structured Streaming jobs with batch twins."""
