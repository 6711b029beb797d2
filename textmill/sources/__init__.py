"""Sources of textmill."""
