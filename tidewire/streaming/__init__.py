"""Incremental and streaming reads."""
