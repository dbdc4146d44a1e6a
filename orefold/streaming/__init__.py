"""Append-only flows with Structured Streaming."""
