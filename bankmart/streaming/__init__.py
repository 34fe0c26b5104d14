"""Incremental Bronze landing with Structured Streaming."""

from bankmart.streaming.incremental import land_available_now

__all__ = ["land_available_now"]
