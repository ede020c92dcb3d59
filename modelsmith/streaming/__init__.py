"""Structured Streaming driver for incremental models."""

from modelsmith.streaming.incremental import stream_into_model

__all__ = ["stream_into_model"]
