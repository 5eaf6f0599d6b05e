"""Readers, parsers and writers."""
