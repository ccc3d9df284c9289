"""Structured Streaming forms: windows that close, running results, runs to the end."""
