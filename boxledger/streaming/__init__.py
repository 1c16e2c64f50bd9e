"""Structured Streaming forms of the landing step."""
from .landing_stream import stream_landing  # noqa: F401
from .upsert_stream import batch_upsert, stream_upsert  # noqa: F401
