"""Structured Streaming jobs. Every query has a checkpoint; every sink can repeat a batch."""
