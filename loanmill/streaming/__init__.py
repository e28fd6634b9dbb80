"""Incremental file-stream variants of the batch loads."""
