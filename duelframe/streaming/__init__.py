"""Structured Streaming entry points (incremental application of the batch
stages; the reference itself has no streaming)."""
