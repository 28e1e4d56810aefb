"""Listings analytics on Spark: sources, operators, plans and streaming."""
