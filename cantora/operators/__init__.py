"""cantora.operators."""
