"""Streaming entry points for the file readers."""
