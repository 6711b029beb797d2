"""Operators of textmill."""
