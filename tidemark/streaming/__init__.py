"""Operators over Structured Streaming."""
