"""cantora.functions."""
