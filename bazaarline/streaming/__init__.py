"""Structured Streaming forms of the incremental loads."""

from .feeds import stream_bronze, stream_warehouse

__all__ = ["stream_bronze", "stream_warehouse"]
