"""Structured Streaming entry points."""

from courtside.streaming.landing_stream import start_bronze_stream

__all__ = ["start_bronze_stream"]
