"""Structured Streaming forms of the incremental operators."""

from strata.streaming.bronze_stream import run_bronze_stream, start_bronze_stream

__all__ = ["run_bronze_stream", "start_bronze_stream"]
