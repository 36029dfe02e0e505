"""Structured Streaming: landing topics and continuous alerts."""
