"""Structured Streaming entry points (only the file-stream form of batch scoring)."""
