"""Marts kept current from growing folders with Structured Streaming."""
