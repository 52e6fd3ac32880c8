"""Structured Streaming: incremental ingest into the staged table."""

from kindred.streaming.ingest import document_stream, read_stage, stream_stage  # noqa: F401
