"""Event-time aggregates over streams of files."""
