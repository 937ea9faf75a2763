"""Readers: files, messages, statements and the landing queue."""
