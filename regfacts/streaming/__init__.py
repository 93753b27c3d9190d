"""Incremental loading with Structured Streaming."""

from regfacts.streaming.ingest import stream_append, stream_ingest  # noqa: F401
from regfacts.streaming.keyed import stream_append_keyed, unique_stream  # noqa: F401
