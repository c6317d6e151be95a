"""Readers and payload parsers."""
