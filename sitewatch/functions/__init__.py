"""Column expressions: URLs, anchors, footer text."""
