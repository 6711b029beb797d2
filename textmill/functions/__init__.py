"""Functions of textmill."""
