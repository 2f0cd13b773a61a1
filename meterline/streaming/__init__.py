"""Structured Streaming jobs. Each starts a query on a checkpoint the caller names."""
