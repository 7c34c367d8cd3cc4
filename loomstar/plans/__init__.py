"""Whole loads, composed of the operators."""
