"""Structured Streaming entry points for the stateless text operators."""
