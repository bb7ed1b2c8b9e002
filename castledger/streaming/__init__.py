"""Incremental bronze loading with Structured Streaming."""
