"""Structured Streaming: ingesting files and keeping current rows."""
