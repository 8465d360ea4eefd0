"""Streaming: the row-level operators on a stream of files."""
