"""Incremental landing folders as streams."""
