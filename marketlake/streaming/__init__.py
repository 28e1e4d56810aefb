"""Incremental consumption of landing files and the state it keeps."""
