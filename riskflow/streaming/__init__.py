"""Structured Streaming helpers: replay sources and query lifecycle."""
