"""Incremental pick-up of landed files with Structured Streaming."""
