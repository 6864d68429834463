"""cantora.sources."""
