"""Readers, catalog views, sinks and the shared staging folder."""
