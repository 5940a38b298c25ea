"""Operators for large training-data pipelines; nothing else in duelframe imports this."""
