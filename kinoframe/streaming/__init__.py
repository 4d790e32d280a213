"""Incremental processing as streams."""
