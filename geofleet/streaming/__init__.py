"""Structured Streaming jobs: the same operators on micro-batches."""
