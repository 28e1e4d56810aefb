"""Assembled tables and the pipeline that builds them."""
