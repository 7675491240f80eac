"""The same jobs as streams."""
