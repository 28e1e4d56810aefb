"""Readers and parsers."""
