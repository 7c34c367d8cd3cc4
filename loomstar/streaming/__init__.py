"""Incremental file pick-up."""
