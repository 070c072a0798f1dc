"""Incremental runs on Structured Streaming's file source."""
