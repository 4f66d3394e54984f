"""Structured Streaming forms of the stages and the stateful rules."""
