"""Structured Streaming jobs over topics and folders."""
