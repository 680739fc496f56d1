"""Structured Streaming use of the stateless parser."""
