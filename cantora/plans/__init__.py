"""cantora.plans."""
