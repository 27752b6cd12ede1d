"""Change detection on append streams."""
