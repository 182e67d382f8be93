"""Column expressions: derived columns, bands and text tokens."""
