"""Page streams."""
