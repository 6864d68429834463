"""cantora.streaming: incremental landing of raw batch files."""
from cantora.streaming.landing import land_stream, text_schema

__all__ = ["land_stream", "text_schema"]
