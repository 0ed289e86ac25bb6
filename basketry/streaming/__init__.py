"""Structured Streaming: topics to raw tables, raw tables to mart tables."""
