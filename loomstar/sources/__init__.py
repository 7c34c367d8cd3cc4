"""Readers, writers and the target schemas."""
