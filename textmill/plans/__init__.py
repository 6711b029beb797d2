"""Plans of textmill."""
