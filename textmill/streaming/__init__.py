"""Streaming of textmill."""
