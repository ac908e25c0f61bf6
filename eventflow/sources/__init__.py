"""Readers and generators (SRC-*)."""
