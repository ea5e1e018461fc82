"""Stateless interval operators on Structured Streaming."""
